"""Registered queries: each operator over the whole of its table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm import (
    centroids,
    euclid,
    licenses,
    lines,
    mixing,
    neardup,
    negatives,
    pieces,
    quality,
    secrets,
    topk,
    toxicity,
    warc,
)
from txnrisk.llm.common import scratch_path, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def piece_model() -> str:
    """The model file: the one that PIECE_MODEL names, else the one for Latin text of the machine."""
    return os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def byte_pairs() -> str:
    """The vocabulary file of byte pairs: the one that BYTE_PAIRS names, else the machine's."""
    return os.environ.get("BYTE_PAIRS", "/opt/tokenizers/byte_bpe_50k.tiktoken")


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.round_trip(docs, piece_model())
    return both.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "round_trip")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that recur across documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_recurring(docs, dropped="n_dropped", pair=12)


ORACLES["op2_line_dedup"] = r"""
WITH texts AS (
    SELECT text, min(doc_id) AS owner FROM documents WHERE text IS NOT NULL GROUP BY text
), lines AS (
    SELECT text, owner, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS pos
    FROM texts
), masked AS (
    SELECT text, owner, pos, string_split(trim(regexp_replace(
        regexp_replace(line, '[^\s]*[0-9][^\s]*', '<*>', 'g'), '\s+', ' ', 'g')), ' ') AS t
    FROM lines
), keyed AS (
    SELECT text, owner, pos, unnest(list_concat(
        ['all ' || len(t) || ' ' || array_to_string(t, ' ')],
        CASE WHEN len(t) >= 12 THEN list_transform(range(4), lambda p: 'part ' || p || ' ' || len(t) || ' ' ||
            array_to_string(t[1:3 + (len(t) - 3) * p // 4], ' ') || ' | ' ||
            array_to_string(t[3 + (len(t) - 3) * (p + 1) // 4 + 1:len(t)], ' ')) ELSE [] END)) AS template, len(t) AS n_tokens
    FROM masked WHERE len(t) >= 3
), recurring AS (
    SELECT template, min((owner, pos)) AS first FROM keyed GROUP BY template, n_tokens
    HAVING count(DISTINCT text) >= CASE WHEN template LIKE 'all %' AND n_tokens >= 12 THEN 2 ELSE 3 END
), cut AS (
    SELECT DISTINCT text, pos FROM keyed JOIN recurring USING (template) WHERE first <> (owner, pos)
), rebuilt AS (
    SELECT text, string_agg(line, chr(10) ORDER BY pos) FILTER (cut.pos IS NULL) AS kept, count(cut.pos) AS n
    FROM lines LEFT JOIN cut USING (text, pos) GROUP BY text
)
SELECT doc_id, CASE WHEN n > 0 THEN kept ELSE text END AS text, coalesce(n, 0) AS n_dropped
FROM documents LEFT JOIN rebuilt USING (text)
WHERE coalesce(n, 0) = 0 OR trim(kept, chr(10) || chr(32) || chr(9) || chr(13)) <> ''
"""


@query
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other vectors of each hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, vectors.where("vec_id % 100 = 0"), k=10)


ORACLES["op3_topk"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and fuzzy notices of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).drop("text", "license_spans")


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, written to an archive and read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    back = warc.round_trip(pages, scratch_path(spark, "warc-archive"))
    return back.select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


ORACLES["op5_warc"] = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
    SELECT page_id, strlen(body) AS payload_bytes, translate(list_aggregate(list_transform(range(8),
        lambda i: to_base(CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT), 32, 4)), 'string_agg', ''),
        '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
    FROM p
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM f
"""


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("held_out")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    training = docs.where(~held_out).join(labels, "doc_id")
    weights, intercept = toxicity.fit(training)
    scored = toxicity.score(docs, weights, intercept)
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    judged = quality.judge(quality.measure(docs).drop("text"))
    return judged.drop("lang", "source")


@query
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their 4-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.components(docs, size=4, percent=80)


ORACLES["op9_minhash"] = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM worded
), rows AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM rows a JOIN rows b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id, doc_id AS other FROM sets UNION SELECT doc_id, b FROM reached JOIN links ON other = a
)
SELECT doc_id, any_value(len(s)) AS n_shingles, min(other) AS component_id, min(other) = doc_id AS kept
FROM reached JOIN sets USING (doc_id) GROUP BY doc_id
"""


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs, ranks_file=byte_pairs()).drop("text")


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each hundredth vector and its nearest vectors of the same label."""
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", turned.alias("label"))
    return negatives.mine(rows, rows.where("vec_id % 100 = 0"))


ORACLES["op11_hard_negatives"] = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
    FROM whole a JOIN whole c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


@query
def op12_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of equal label with a cosine of at least 0.93."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return euclid.components(rows, cosine=0.93)


ORACLES["op12_embedding_neardup"] = """
WITH RECURSIVE doubled AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), usable AS (
    SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM doubled
    WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93
), reached AS (
    SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT vec_id, b FROM reached JOIN links ON other = a
), n AS (
    SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, any_value(coalesce(n_links, 0)) AS n_links, min(other) AS component_id, min(other) = vec_id AS kept
FROM reached LEFT JOIN n USING (vec_id) GROUP BY vec_id
"""


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all vectors after ten rounds."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return centroids.cluster(rows, size=64, k=8, rounds=10, scale=1024.0, seed="3")


ASSIGN = """a{0} AS MATERIALIZED (
    SELECT row, v, min(x).c AS cluster, min(x).d AS distance FROM (
        SELECT row, v, {{'d': CAST(list_sum(list_transform(list_zip(v, centre), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT),
                        'c': c}} AS x
        FROM whole, c{0}
    ) GROUP BY row, v)"""
MOVE = """c{1} AS MATERIALIZED (
    SELECT c, coalesce(moved, centre) AS centre FROM c{0} LEFT JOIN (
        SELECT cluster, list(m ORDER BY dim) AS moved FROM (
            SELECT cluster, dim, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM (
                SELECT cluster, dim, sum(value) AS s, count(*) AS n FROM (
                    SELECT cluster, unnest(v) AS value, unnest(range(len(v))) AS dim FROM a{0}
                ) GROUP BY cluster, dim)
        ) GROUP BY cluster) ON cluster = c)"""


def _rounds(n: int) -> str:
    """``n`` rounds as common tables: centroids c0 to c<n>, and a<i>, the assignments to c<i>."""
    return ",\n".join(f"{ASSIGN.format(i)},\n{MOVE.format(i, i + 1)}" for i in range(n)) + f",\n{ASSIGN.format(n)}"


ORACLES["op13_centroids"] = f"""
WITH whole AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS INTEGER) AS c, v AS centre
    FROM whole WHERE vec_id IS NOT NULL QUALIFY c < 8
), {_rounds(10)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(centre, ',')) AS centroid_sha256
FROM a10 JOIN whole USING (row) JOIN c10 ON c = cluster
"""
