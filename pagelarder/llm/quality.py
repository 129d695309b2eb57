"""Quality classifier: a convolutional network over bytes, in numpy.

Bytes are embedded in 8 numbers. Filters of 8 bytes, 4 bytes apart, run over the whole text.
Chunks of 512 bytes overlap by half; in each the responses of a filter are max-pooled. The maximum
and the mean of the chunks' vectors go through a hidden layer to one probability.

Training runs on the driver on at most `rows` labelled documents, picked by a hash of their ids,
of which at most 16 KB each are used: all of a shorter text, of others pieces at even distances
over the whole text, taken in the tasks. That sample is the only bound; scoring reads every byte of every text, in blocks of bounded size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelarder.llm.common import free_name

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMS, STRIDE, FILTERS, HIDDEN = 8, 4, 32, 16
HALF = 256  # bytes of half a chunk
WINDOWS = HALF // STRIDE
BLOCK = 1 << 18  # bytes whose responses are held at once
TRAIN_ROWS, TRAIN_BYTES, STEPS, BATCH = 3000, 16 << 10, 600, 32
THRESHOLD = 0.3


def new_weights(seed: int = 6) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)

    def normal(*shape, scale):
        return (r.standard_normal(shape) * scale).astype(np.float32)

    return {
        "embed": normal(256, DIMS, scale=0.5),
        "now": normal(STRIDE * DIMS, FILTERS, scale=0.2),
        "next": normal(STRIDE * DIMS, FILTERS, scale=0.2),
        "bias": np.zeros(FILTERS, np.float32),
        "hidden": normal(2 * FILTERS, HIDDEN, scale=0.15),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "out": normal(HIDDEN, scale=0.3),
        "out_bias": np.zeros(1, np.float32),
    }


def _halves(text: bytes) -> np.ndarray:
    """Bytes as rows of half chunks, two at least, the last filled up with zero bytes."""
    n = max(2, -(-len(text) // HALF))
    out = np.zeros(n * HALF, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, HALF)


def _responses(w: dict, halves: np.ndarray) -> np.ndarray:
    """Filter responses: (half chunks, windows, filters). Windows reach 4 bytes into the next one."""
    x = w["embed"][halves.reshape(-1)].reshape(-1, STRIDE * DIMS)
    y = x @ w["now"] + w["bias"]
    y[:-1] += x[1:] @ w["next"]
    return y.reshape(len(halves), WINDOWS, FILTERS)


def _document(w: dict, chunk_max: np.ndarray, chunk_mean: np.ndarray):
    pooled = np.concatenate([chunk_max, chunk_mean], axis=1)
    hidden = np.tanh(pooled @ w["hidden"] + w["hidden_bias"])
    return pooled, hidden, hidden @ w["out"] + w["out_bias"]


def score(w: dict, text: str | None) -> float:
    """Probability of label 1 for a whole text, read in blocks; an empty text has one, too."""
    data = (text or "").encode("utf-8", "surrogatepass")
    last, top, total, n, at = None, np.zeros(FILTERS, np.float32), np.zeros(FILTERS), 0, 0
    while at == 0 or at < len(data):
        piece = _halves(data[at : at + BLOCK])
        # The responses of the last window need 4 bytes of what follows.
        after = np.zeros((1, HALF), np.uint8)
        follow = np.frombuffer(data[at + BLOCK : at + BLOCK + STRIDE], np.uint8)
        after[0, : len(follow)] = follow
        y = _responses(w, np.concatenate([piece, after]))[:-1]
        peaks = np.maximum(y.max(axis=1), 0)
        if last is not None:
            peaks = np.concatenate([last[None], peaks])
        chunks = np.maximum(peaks[:-1], peaks[1:])
        top = np.maximum(top, chunks.max(axis=0))
        total += chunks.sum(axis=0)
        n, last, at = n + len(chunks), peaks[-1], at + BLOCK
    _, _, logit = _document(w, top[None], (total / n).astype(np.float32)[None])
    return float(1 / (1 + np.exp(-np.clip(logit[0], -30, 30))))


def _loss_gradients(w: dict, docs: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the log loss of a batch; maxima pass theirs to where they were reached."""
    halves = np.concatenate(docs)
    sizes = np.array([len(d) for d in docs])
    y = _responses(w, halves)
    where = y.argmax(axis=1)  # (halves, filters)
    peaks = np.maximum(np.take_along_axis(y, where[:, None], 1)[:, 0], 0)
    # A chunk is a half and the next one of its document.
    first = np.concatenate([np.arange(s - 1) + o for s, o in zip(sizes, np.cumsum(sizes) - sizes, strict=True)])
    chunks = np.maximum(peaks[first], peaks[first + 1])
    begin = np.cumsum(sizes - 1) - (sizes - 1)
    top = np.maximum.reduceat(chunks, begin)
    mean = np.add.reduceat(chunks, begin) / (sizes - 1)[:, None]
    pooled, hidden, logit = _document(w, top, mean)
    error = (1 / (1 + np.exp(-logit)) - labels) / len(labels)

    g = {"out": hidden.T @ error, "out_bias": np.array([error.sum()])}
    d_hidden = error[:, None] * w["out"] * (1 - hidden**2)
    g["hidden"], g["hidden_bias"] = pooled.T @ d_hidden, d_hidden.sum(0)
    d_pooled = d_hidden @ w["hidden"].T
    owner = np.repeat(np.arange(len(sizes)), sizes - 1)
    d_chunks = d_pooled[owner, FILTERS:] / (sizes - 1)[owner, None]
    is_top = chunks == top[owner]
    ties = np.add.reduceat(is_top.astype(np.float32), begin)
    d_chunks += is_top * (d_pooled[:, :FILTERS] / ties)[owner]
    left = peaks[first] >= peaks[first + 1]
    d_peaks = np.zeros_like(peaks)
    d_peaks[first] += d_chunks * left  # `first` has no value twice
    d_peaks[first + 1] += d_chunks * ~left
    d_peaks *= peaks > 0

    d_y = np.zeros_like(y)
    np.put_along_axis(d_y, where[:, None], d_peaks[:, None], 1)
    d_y = d_y.reshape(-1, FILTERS)
    x = w["embed"][halves.reshape(-1)].reshape(-1, STRIDE * DIMS)
    g["now"], g["bias"] = x.T @ d_y, d_y.sum(0)
    g["next"] = x[1:].T @ d_y[:-1]
    d_x = d_y @ w["now"].T
    d_x[1:] += d_y[:-1] @ w["next"].T
    d_x = d_x.reshape(-1, DIMS)
    used = halves.reshape(-1)
    g["embed"] = np.stack([np.bincount(used, d_x[:, k], 256) for k in range(DIMS)], 1)
    return g


def _excerpt(text: str | None) -> np.ndarray:
    """Half chunks of a text for training; of a long one, evenly spaced pairs of them."""
    halves = _halves((text or "").encode("utf-8", "surrogatepass"))
    limit = TRAIN_BYTES // HALF
    if len(halves) <= limit:
        return halves
    at = np.linspace(0, len(halves) - 2, limit // 2).astype(int)
    return np.concatenate([halves[i : i + 2] for i in at])


def train(excerpts: list[bytes], labels: list[int], seed: int = 6) -> dict[str, np.ndarray]:
    """Weights learned by Adam from the half chunks of `_excerpt`. With labels of one kind only, or none, a constant score results."""
    w = new_weights(seed)
    rate = (sum(labels) + 1) / (len(labels) + 2)
    w["out_bias"][0] = np.log(rate / (1 - rate))
    if len(set(labels)) < 2:
        w["out"][:] = 0
        return w
    docs = [np.frombuffer(x, np.uint8).reshape(-1, HALF) for x in excerpts]
    y = np.array(labels, np.float32)
    moment = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    r, order = np.random.default_rng(seed), np.empty(0, int)
    for step in range(1, STEPS + 1):
        if not len(order):
            order = r.permutation(len(docs))
        some, order = order[:BATCH], order[BATCH:]
        speed = 0.004 * (1 - step / (STEPS + 1))
        for k, g in _loss_gradients(w, [docs[i] for i in some], y[some]).items():
            moment[k] += 0.1 * (g - moment[k])
            square[k] += 0.01 * (g * g - square[k])
            size = np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7
            w[k] -= (speed * moment[k] / (1 - 0.9**step) / size).astype(np.float32)
    return w


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """text, label of at most `rows` labelled documents that are not held out.

    Labels of one document are averaged, null ones left out. The sample is the least hashes of
    ids, the same at every run; it has a bounded size, so it is broadcast to the documents.
    """
    known = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("_id", F.lit("sample"))).limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id")).groupBy("_id").agg(
        F.max("text").alias("text"), F.max("label").alias("label")
    )


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    sample = training_rows(docs, labels, rows).select("_id", "label", "text")
    sample = sample.mapInArrow(_excerpts, "_id long, label int, excerpt binary")
    found = sorted(sample.collect())  # at most `rows` rows of TRAIN_BYTES
    return train([r.excerpt for r in found], [r.label for r in found])


def _excerpts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each text by the bytes that are learned from, by one rule for all lengths."""
    for batch in batches:
        cut = [_excerpt(text.as_py()).tobytes() for text in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int32()), pa.array(cut, pa.binary())],
            names=["_id", "label", "excerpt"],
        )


def scored(docs: DataFrame, weights: dict, column: str = "score") -> DataFrame:
    """`docs` with a score of 0 to 1 per row. Only the text is looked at; null counts as empty."""
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [score(weights, text.as_py()) for text in batch.column(place)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, column]
            )

    return docs.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    rows = scored(docs.select("doc_id", "text"), fit(docs, labels))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier predicts to be of quality 1, with all their columns."""
    score = free_name(docs, "_score")
    rows = scored(docs, fit(docs, labels), score)
    return rows.where(F.col(score) >= THRESHOLD).drop(score)
