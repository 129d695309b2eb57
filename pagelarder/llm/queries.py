"""The queries of the operators, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from pagelarder.llm import (
    balanced, centroids, contamination, exact, line_runs, main_text, mixing, odd_sketch, periodic, quality,
    token_shards, unit_dedup, warc,
)
from pagelarder.llm.common import table


def op1_decontamination(spark, sf_dir):
    return contamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_html_extraction(spark, sf_dir):
    return main_text.extract_main_text(table(spark, sf_dir, "pages"))


def op3_token_shards(spark, sf_dir):
    return token_shards.materialised(spark, table(spark, sf_dir, "documents"))


def op4_source_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = mixing.rated(docs)
    return rows.selectExpr(
        "doc_id", "_size AS size", "_source_size AS source_size", "_target AS target",
        "_size * _copies AS taken",
    )


def op5_exact_dedup(spark, sf_dir):
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark, sf_dir):
    """The documents that lose a passage, with what stays of them."""
    return unit_dedup.without_repeats(table(spark, sf_dir, "documents")).where("size(removed) > 0")


def op8_warc(spark, sf_dir):
    rows = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_line_dedup(spark, sf_dir):
    return line_runs.without_repeated_lines(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark, sf_dir):
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"), similarity=85)


def op11_periodic_runs(spark, sf_dir):
    docs = periodic.repeating_tails(table(spark, sf_dir, "documents"))
    return periodic.run_report(periodic.without_periodic_runs(docs))


def op12_sharding(spark, sf_dir):
    return balanced.document_shards(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark, sf_dir):
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OP1 = r"""
WITH words AS (
    SELECT doc_id AS id, 'd' AS side, lower(text) AS t FROM documents
    UNION ALL SELECT item_id, 'i', lower(text) FROM benchmark
), split AS (
    SELECT id, side, list_filter(string_split_regex(coalesce(t, ''), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
    FROM words
), shingles AS (
    SELECT DISTINCT side, id, unnest(list_transform(range(1, len(w) - 3),
        lambda i: array_to_string(w[i:i + 4], ' '))) AS s
    FROM split WHERE len(w) >= 5
), sizes AS (SELECT id, count(*) AS n FROM shingles WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, any_value(n) AS n_item, count(*) AS n_shared
FROM shingles d JOIN shingles i ON d.s = i.s AND d.side = 'd' AND i.side = 'i'
JOIN sizes z ON z.id = i.id
GROUP BY d.id, i.id HAVING count(*) * 100 >= any_value(n) * 80
"""

OP5 = r"""
WITH plain AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t FROM documents
), ranked AS (
    SELECT doc_id, t, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
    FROM plain WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM ranked
"""

OP8 = r"""
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT *, CASE WHEN payload_bytes >= 100
        THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

OP10 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT doc_id, hash(s) AS s FROM (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
        FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
    JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 85 * (any_value(m.n) + any_value(n.n) - count(*))
), reach(x, y) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT r.x, l.y FROM reach r
        JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) l ON l.x = r.y
), least AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

# The CRC of a text is a fold over its bytes, read from their hexadecimal digits, by a table that
# is computed here, too.
OP12 = r"""
WITH steps AS (
    SELECT b, list_reduce(list_prepend(b, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(b)
), crc AS (SELECT list(v ORDER BY b) AS t FROM steps
), bytes AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h
    FROM documents
), sized AS (
    SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)),
        lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS text_crc32
    FROM bytes, crc
), running AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id NULLS LAST, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS up_to,
        sum(size) OVER () AS total FROM sized
), sharded AS (SELECT *, ((2 * up_to - size) * 16 // (2 * total))::INT AS shard FROM running)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY up_to) - 1 AS slot, NULL::INT AS grown_shard
FROM sharded
"""


def _op13(rounds: int = centroids.ROUNDS) -> str:
    """k-means in whole numbers: a pair of steps, assignment and means, for each round."""
    steps = [f"""
WITH kept AS (
    SELECT row_number() OVER () AS row, vec_id,
        list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.WIDTH}
        AND len(embedding) = {centroids.WIDTH}
), c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id), v) - 1 AS c, v AS w FROM kept
    QUALIFY c < {centroids.K}
)"""]  # fmt: skip
    nearest = """, a{n} AS MATERIALIZED (
    SELECT DISTINCT ON (row) row, vec_id, v, c,
        list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
    FROM kept, c{n} ORDER BY row, distance, c
)"""
    means = """, c{m} AS MATERIALIZED (
    SELECT c, coalesce(new.w, c{n}.w) AS w FROM c{n} LEFT JOIN (
        SELECT c, list((s - ((s % k) + k) % k) // k ORDER BY d)::BIGINT[] AS w FROM (
            SELECT c, d, sum(v[d]) AS s, count(*) AS k FROM a{n}, range(1, 65) t(d) GROUP BY c, d
        ) GROUP BY c) new USING (c)
)"""
    for n in range(rounds):
        steps += [nearest.format(n=n), means.format(n=n, m=n + 1)]
    steps.append(nearest.format(n=rounds))
    steps.append(f"""
SELECT vec_id, c::INT AS cluster, distance::BIGINT AS distance,
    (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)""")
    return "".join(steps)


QUERIES = {
    "op1_decontamination": (op1_decontamination, OP1),
    "op2_html_extraction": (op2_html_extraction, None),
    "op3_token_shards": (op3_token_shards, None),
    "op4_source_mixing": (op4_source_mixing, None),
    "op5_exact_dedup": (op5_exact_dedup, OP5),
    "op6_quality_classifier": (op6_quality_classifier, None),
    "op7_substring_dedup": (op7_substring_dedup, None),
    "op8_warc": (op8_warc, OP8),
    "op9_line_dedup": (op9_line_dedup, None),
    "op10_near_dedup": (op10_near_dedup, OP10),
    "op11_periodic_runs": (op11_periodic_runs, None),
    "op12_sharding": (op12_sharding, OP12),
    "op13_centroid_clustering": (op13_centroid_clustering, _op13()),
    "pipeline": (pipeline, None),
}
