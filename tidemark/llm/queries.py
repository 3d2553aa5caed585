"""Registered queries over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import table
from tidemark.llm.de_bruijn import repeated_words, unitigs
from tidemark.llm.decontaminate import contamination
from tidemark.llm.exact import exact_duplicates
from tidemark.llm.html_text import extract
from tidemark.llm.jaccard import similar_documents
from tidemark.llm.language import identify
from tidemark.llm.packing import pack
from tidemark.llm.pii import personal_data
from tidemark.llm.pivots import CENTROIDS, DIMENSIONS, ROUNDS, cluster_vectors
from tidemark.llm.prefix_trie import prefix_trie
from tidemark.llm.secrets import secret_spans
from tidemark.llm.sharding import shard_documents
from tidemark.llm.suffix_buckets import repeated_bytes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("op1_pii_transducers")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


@query("op2_label_propagation")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"))


@query(
    "op3_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
              sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


@query("op4_suffix_buckets")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_bytes(table(spark, folder, "documents")).drop("span_starts", "span_ends", "row")


@query("op5_simhash_decontamination")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_html_text")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


@query("op7_de_bruijn")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    spans = repeated_words(table(spark, folder, "documents"))
    here = unitigs(spans).groupBy("doc_id").agg(F.countDistinct("unitig").alias("n_unitigs"))
    return spans.drop("span_starts", "span_ends", "paths", "row").join(here, "doc_id", "left").fillna(0, ["n_unitigs"])


@query("op8_language_id")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


@query("op9_configuration_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


@query("op10_jaccard_join")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return similar_documents(table(spark, folder, "documents")).drop("text_md5")


def _nearest(k: int) -> str:
    """a<k>: each vector's nearest centroid of c<k>, of equally near ones the first, and the squared distance."""
    square = "list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"""a{k} AS (SELECT vec_id, row, min((d, cluster)) AS best FROM (SELECT v.vec_id, v.row, CAST({square} AS BIGINT) AS d, c.cluster FROM v CROSS JOIN c{k} c) GROUP BY vec_id, row)"""


def _moved(k: int) -> str:
    """c<k>: the floors of the means of a<k-1>'s vectors; centroids without vectors stay."""
    floor = "CAST((s - ((s % n) + n) % n) / n AS BIGINT)"
    return f"""m{k} AS (SELECT cluster, list({floor} ORDER BY i) AS q FROM (
                 SELECT a.best[2] AS cluster, i, sum(v.q[i]) AS s, count(*) AS n FROM a{k - 1} a JOIN v USING (row) CROSS JOIN generate_series(1, {DIMENSIONS}) g(i) GROUP BY 1, 2) GROUP BY 1),
               c{k} AS (SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{k - 1} c LEFT JOIN m{k} m USING (cluster))"""


_CLUSTERS = f"""
WITH v AS (SELECT vec_id, embedding, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), embedding) AS row,
             list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     c0 AS (SELECT row - 1 AS cluster, q FROM v WHERE row <= {CENTROIDS}),
     {", ".join(f"{_nearest(k)}, {_moved(k + 1)}" for k in range(ROUNDS))}, {_nearest(ROUNDS)}
SELECT a.vec_id, CAST(a.best[2] AS INTEGER) AS cluster, a.best[1] AS distance, CAST(sum(a.best[1]) OVER (PARTITION BY a.best[2]) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.cluster = a.best[2]"""


@query("op11_pivot_clusters", _CLUSTERS)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_vectors(table(spark, folder, "embeddings")).drop("n_exact")


#: CRC-32 of a text of plain characters, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
              lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))"""

_TRIE = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
     ids AS (SELECT c, {_CRC32.format("CAST(c AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
     turns AS (SELECT ids.c, 0 AS own, t.pos, t.role, t.text FROM ids JOIN t ON t.c = ids.c - ids.c % 20 AND t.pos < h
               UNION ALL SELECT ids.c, 1, t.pos, t.role, t.text FROM ids JOIN t ON t.c = ids.c AND t.pos >= h),
     s AS (SELECT ids.c, coalesce(list((turns.role, turns.text) ORDER BY own, pos) FILTER (turns.c IS NOT NULL), []) AS s FROM ids LEFT JOIN turns USING (c) GROUP BY ids.c),
     m AS (SELECT c, d, s[1:d] AS p, len(s) = d AS ends FROM (SELECT c, s, unnest(generate_series(0, len(s))) AS d FROM s)),
     n AS (SELECT d, p, min(c) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY d, p),
     k AS (SELECT x.d, x.p, any_value(x.conv_id) AS conv_id, any_value(x.n) AS n, any_value(x.ends_sha256) AS ends_sha256, count(y.d) AS kids,
             CASE WHEN x.d = 0 THEN 0 ELSE (any_value(x.n) - 1) * len(regexp_extract_all(x.p[x.d][2], '[^\x20\x09-\x0D]+')) END AS saves
           FROM n x LEFT JOIN n y ON y.d = x.d + 1 AND y.p[1:x.d] = x.p GROUP BY x.d, x.p)
SELECT x.conv_id, x.d AS depth, any_value(up.conv_id) AS parent_conv_id, any_value(x.n) AS n_convs, any_value(x.kids) AS n_children,
  CAST(sum(CASE WHEN y.kids = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum(y.saves) AS BIGINT) AS saved_tokens, any_value(x.ends_sha256) AS ends_sha256
FROM k x JOIN k y ON y.d >= x.d AND y.p[1:x.d] = x.p LEFT JOIN n up ON up.d = x.d - 1 AND up.p = x.p[1:x.d - 1]
GROUP BY x.conv_id, x.d"""


@query("op12_prefix_trie", _TRIE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))


@query("op13_secret_scan")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return secret_spans(table(spark, folder, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
