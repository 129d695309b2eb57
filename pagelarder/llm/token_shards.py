"""Token shards in training order.

1. Texts become token ids, each text ended by an end token. The ids of all texts are one stream,
   cut into sequences of `length` tokens; the last one is filled up with end tokens.
2. A keyed Feistel permutation of the numbers below the next power of four, walked until it
   falls below the number of sequences, gives every sequence its slot in the training order: a
   bijection that each task computes alone, with no table of slots and no sort of sequences.
3. A range of slots is a shard: a file in which slot s has the bytes from (s - first) * stride
   on. Reading in training order is sequential, and a reader that stopped at slot s goes on there.

The place of a text in the stream is the number of tokens before it: a task numbers the tokens
of its own partition, and the totals of the partitions before it, one number each, are added.
Tokens move once, packed per task and shard.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelarder.llm import common
from pagelarder.llm.common import shared_folder, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(common)

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# How the vocabulary's text is cut before merging: a fixed value that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space as the pattern has it, in runs too long to be matched by it.
_LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
END = 50256
LENGTH, SHARD_SEQUENCES, ROUNDS = 1024, 8192, 6
_PIECE = np.dtype([("slot", "<i8"), ("doc", "<i8"), ("at", "<i4"), ("n", "<i4")])
_NO_DOC = np.iinfo(np.int64).min
_BUFFER = 4 << 20  # tokens a task packs at once

TOKENS = "doc_id long, part int, start long, n long, tokens binary"


@cache
def encoder(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Token ids of a text and the end token; a null or empty text is the end token alone.

    The pattern cuts a run of white space where it begins, and before its last character if
    something follows. What lies between is one piece to merge. Long runs are cut out there
    beforehand, as matching them needs a stack as deep as they are long; the ids are the same.
    """
    coder, text, found, at = encoder(vocabulary), text or "", [], 0
    for run in _LONG_RUN.finditer(text):
        stop = run.end() - (run.end() < len(text))
        found += coder.encode_ordinary(text[at : run.start()])
        found += coder._encode_single_piece(text[run.start() : stop].encode())
        at = stop
    found += coder.encode_ordinary(text[at:])
    found.append(END)
    return np.array(found, np.uint16)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(sequence: np.ndarray, count: int, key: int) -> np.ndarray:
    """The slots of sequences under a keyed permutation of range(count)."""
    half = np.uint64(max(1, (max(count - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = [
        np.uint64(int.from_bytes(hashlib.blake2b(f"{key}/{i}".encode(), digest_size=8).digest(), "little"))
        for i in range(ROUNDS)
    ]
    out = sequence.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= np.uint64(count)]
    return out.astype(np.int64)


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    """Tokens of each text and how many tokens of this partition come before it."""
    part, start = TaskContext.get().partitionId(), 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            tokens = [encode(text.as_py(), vocabulary) for text in some.column(1)]
            sizes = np.array([len(t) for t in tokens], np.int64)
            starts = start + np.cumsum(sizes) - sizes
            start += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(np.full(len(tokens), part, np.int32)), pa.array(starts),
                 pa.array(sizes), pa.array([t.tobytes() for t in tokens], pa.binary())],
                names=["doc_id", "part", "start", "n", "tokens"],
            )


def tokenised(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, part, start, n, tokens (two bytes each, little end first), stored."""
    rows = docs.select("doc_id", "text").mapInArrow(lambda b: _encode(b, vocabulary), TOKENS)
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession, "tokens")
    rows.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _packed(batches: Iterator[pa.RecordBatch], count: int, length: int, per_shard: int, key: int):
    """Cut texts at sequence borders and pack the pieces of a shard: (shard, packed bytes)."""
    pieces: list[tuple[np.ndarray, np.ndarray]] = []
    held, packer = 0, zstandard.ZstdCompressor(level=1)

    def flush() -> pa.RecordBatch:
        head = np.concatenate([p for p, _ in pieces])
        tokens = np.concatenate([t for _, t in pieces])
        begin = np.cumsum(head["n"].astype(np.int64)) - head["n"]
        head["slot"] = permuted(head["slot"], count, key)
        order = np.argsort(head["slot"], kind="stable")
        head, begin = head[order], begin[order]
        shard = head["slot"] // per_shard
        edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)) if len(shard) else []
        shards, blobs = [], []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = [tokens[s : s + n] for s, n in zip(begin[a:b], head["n"][a:b], strict=True)]
            data = np.int64(b - a).tobytes() + head[a:b].tobytes() + np.concatenate(own).tobytes()
            shards.append(int(shard[a]))
            blobs.append(packer.compress(data))
        pieces.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(shards, pa.int64()), pa.array(blobs, pa.binary())], names=["shard", "pieces"]
        )

    for batch in batches:
        for doc, start, data in zip(*batch.columns, strict=True):
            tokens = np.frombuffer(data.as_py(), np.uint16)
            first, n = start.as_py(), len(tokens)
            cuts = np.arange(first // length, (first + n - 1) // length + 1, dtype=np.int64)
            head = np.zeros(len(cuts), _PIECE)
            head["slot"] = cuts  # the sequence, until it is permuted
            head["doc"] = _NO_DOC if doc.as_py() is None else doc.as_py()
            begin = np.maximum(cuts * length, first)
            head["at"] = begin - cuts * length
            head["n"] = np.minimum((cuts + 1) * length, first + n) - begin
            pieces.append((head, tokens))
            held += n
            if held >= _BUFFER:
                yield flush()
                held = 0
    if pieces:
        yield flush()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    stop = 8 + n * _PIECE.itemsize
    return np.frombuffer(data[8:stop], _PIECE), np.frombuffer(data[stop:], np.uint16)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _write(batches, folder: str, total: int, count: int, length: int, per_shard: int):
    """Fill each shard and write it. A file is complete before it gets its name, so a retry or a
    second copy of a task replaces it by the same bytes."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    for rows in common.runs_of(batches, "shard"):
        shard = rows.column("shard")[0].as_py()
        first = shard * per_shard
        slots = min(per_shard, count - first)
        body = np.full((slots, length), END, np.uint16)
        filled = np.zeros(slots, np.int64)
        owners = []
        for blob in rows.column("pieces"):
            head, tokens = _unpack(blob.as_py())
            at = 0
            for slot, doc, begin, n in head.tolist():
                body[slot - first, begin : begin + n] = tokens[at : at + n]
                filled[slot - first] += n
                owners.append((slot - first, begin, doc))
                at += n
        if (filled != length).sum() > (total % length > 0):
            raise ValueError(f"shard {shard} lacks tokens")
        name = f"{path}/{shard_name(shard)}"
        own = f"{name}.{uuid.uuid4().hex}"
        with system.open_output_stream(own, compression=None) as file:
            file.write(memoryview(body).cast("B"))
        system.move(own, name)
        owners.sort()
        docs: list[list] = [[] for _ in range(slots)]
        for slot, _, doc in owners:
            docs[slot].append(None if doc == _NO_DOC else doc)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(first, first + slots)), pa.array([shard_name(shard)] * slots),
             pa.array(filled.astype(np.int32)), pa.array(docs, pa.list_(pa.int64()))],
            names=["slot", "shard", "n_tokens", "doc_ids"],
        )


def write_shards(
    docs: DataFrame, folder: str, key: int = 20240, length: int = LENGTH,
    per_shard: int = SHARD_SEQUENCES, vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Write all texts below `folder`; returns slot, shard, n_tokens, doc_ids for each sequence.

    Every row counts, repeated ones and those with a null doc_id too; a null or empty text is an
    end token. n_tokens leaves out what fills up the last sequence; doc_ids are the documents of
    a sequence in order. An empty table has no sequence and no shard. The order of the stream is
    that of the input's partitions; `key` chooses the order of training.
    """
    tokens = tokenised(docs, vocabulary)
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n"))  # a row per partition of the input
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    totals = stored(totals.select(F.col("part").alias("p"), before.alias("before"), "n"), "totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    count = -(-total // length)
    rows = tokens.join(F.broadcast(totals), F.col("part") == F.col("p"))
    rows = rows.select("doc_id", (F.col("before") + F.col("start")).alias("start"), "tokens")
    pieces = rows.mapInArrow(
        lambda b: _packed(b, count, length, per_shard, key), "shard long, pieces binary"
    )
    shards = pieces.repartition("shard").sortWithinPartitions("shard")
    manifest = shards.mapInArrow(
        lambda b: _write(b, folder, total, count, length, per_shard),
        "slot long, shard string, n_tokens int, doc_ids array<bigint>",
    )
    return stored(manifest, "manifest")


def _read(batches, folder: str, length: int, per_shard: int, first: int, last: int):
    """Sequences of shards in slot order, from their bytes."""
    system, path = fs.FileSystem.from_uri(folder)
    stride = 2 * length
    for batch in batches:
        for name in batch.column(0).to_pylist():
            start = int(name.split("-")[1].split(".")[0]) * per_shard
            with system.open_input_file(f"{path}/{name}") as file:
                slots = range(max(start, first), min(start + file.size() // stride, last))
                file.seek((slots.start - start) * stride)
                for at in range(slots.start, slots.stop, 512):
                    n = min(512, slots.stop - at)
                    data = file.read(n * stride)
                    cut = [data[i * stride : (i + 1) * stride] for i in range(n)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(at, at + n)), pa.array([name] * n),
                         pa.array((np.arange(at, at + n) - start) * stride), pa.array(cut, pa.binary())],
                        names=["slot", "shard", "byte_offset", "tokens"],
                    )


def read_shards(
    manifest: DataFrame, folder: str, length: int = LENGTH, per_shard: int = SHARD_SEQUENCES,
    first: int = 0, last: int = 1 << 62,
) -> DataFrame:
    """slot, shard, byte_offset, tokens of the slots from `first` up to `last`, read from the files."""
    names = manifest.where((F.col("slot") >= first) & (F.col("slot") < last)).select("shard").distinct()
    # Names are few bytes and shards are many, so tasks are counted, not merged by the size of names.
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(tasks, "shard").mapInArrow(
        lambda b: _read(b, folder, length, per_shard, first, last),
        "slot long, shard string, byte_offset long, tokens binary",
    )


def materialised(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write all shards to the shared folder and read them back: a row per sequence, with its
    slot, place, documents, number of tokens and the SHA-256 of its bytes as read."""
    folder = shared_folder(spark, "shards")
    manifest = write_shards(docs, folder)
    read = read_shards(manifest, folder).select(
        "slot", "byte_offset", F.unhex(F.sha2("tokens", 256)).alias("digest")
    )
    # Both sides have a row per sequence, so neither is broadcast.
    return manifest.join(read.hint("merge"), "slot").select(
        "slot", "shard", "byte_offset", "n_tokens", "doc_ids", F.lower(F.hex("digest")).alias("sha256")
    )
