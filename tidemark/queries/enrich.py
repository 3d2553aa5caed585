"""Enrichment queries with deterministic scorers in place of a model."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A, enrich as N, hooks, joins as J, ordering as O
from tidemark.queries.registry import query


def _answer(text: str) -> str:
    words = len(text.split(" "))
    risk = "high" if words > 300 else "MEDIUM" if words > 100 else "unsure"
    return f'My view: {{"risk": "{risk}", "words": {words}}} as asked.'


def scorer(column):
    """A model stand-in: whole texts in Arrow batches, one JSON answer inside prose each."""

    @F.pandas_udf("string")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(_answer)

    return score(column)


WORDS = "len(string_split(text, ' '))"
RISK = f"CASE WHEN {WORDS} > 300 THEN 'HIGH' WHEN {WORDS} > 100 THEN 'MEDIUM' ELSE 'LOW' END"


@query(
    "enr01_budgeted_rows",
    f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn FROM documents)
    SELECT doc_id, CASE WHEN rn <= 150 THEN 'My view: {{"risk": "' || CASE WHEN {WORDS} > 300 THEN 'high' WHEN {WORDS} > 100 THEN 'MEDIUM' ELSE 'unsure' END || '", "words": ' || {WORDS} || '}} as asked.' END AS answer FROM r""",
)
def enr01(t):
    return N.enrich(t.documents, "doc_id", 150, "answer", scorer, "text").select("doc_id", "answer")


@query(
    "enr02_context_text",
    """WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY n DESC, o_orderpriority) AS rn FROM c)
    SELECT o_orderstatus, string_agg(o_orderpriority || ': ' || n, chr(10) ORDER BY rn) AS context FROM r WHERE rn <= 3 GROUP BY o_orderstatus""",
)
def enr02(t):
    counted = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    top = O.top_n_per(counted, ["o_orderstatus"], [F.desc("n"), F.asc("o_orderpriority")], 3, "rank")
    line = F.concat(F.col("o_orderpriority"), F.lit(": "), F.col("n").cast("string"))
    return N.context_text(top, ["o_orderstatus"], "rank", line, "context")


@query(
    "enr03_structured_answers",
    f"SELECT doc_id, {RISK} AS risk, CAST({WORDS} AS INTEGER) AS words FROM documents",
)
def enr03(t):
    """Typed fields out of the answers; a value outside the allowed list takes the default."""
    answered = t.documents.select("doc_id", scorer(F.col("text")).alias("answer"))
    parsed = answered.select("doc_id", N.structured(F.col("answer"), "risk string, words int").alias("a"))
    return parsed.select("doc_id", N.allowed(F.col("a.risk"), ["HIGH", "MEDIUM", "LOW"], "LOW").alias("risk"), F.col("a.words").alias("words"))


@query(
    "enr04_consensus",
    f"""SELECT doc_id, {RISK} AS first_opinion, CASE WHEN n_chars > 2000 THEN 'HIGH' WHEN n_chars > 600 THEN 'MEDIUM' ELSE 'LOW' END AS second_opinion,
    {RISK} <> CASE WHEN n_chars > 2000 THEN 'HIGH' WHEN n_chars > 600 THEN 'MEDIUM' ELSE 'LOW' END AS disagree, {RISK} AS consensus FROM documents""",
)
def enr04(t):
    first = enr03(t).select("doc_id", F.col("risk").alias("verdict"))
    size = F.col("n_chars")
    second = t.documents.select("doc_id", F.when(size > 2000, "HIGH").when(size > 600, "MEDIUM").otherwise("LOW").alias("verdict"))
    return N.consensus(J.both_opinions(first, second, "doc_id", "verdict"))


@query(
    "enr05_discovery",
    """WITH seed AS (SELECT c_nationkey, c_custkey FROM customer WHERE c_acctbal < 0 AND c_nationkey < 8), p AS (SELECT (c_custkey + 3) % 25 AS k FROM seed UNION ALL SELECT (c_custkey + 11) % 25 FROM seed),
    r AS (SELECT k, count(*) AS support FROM p WHERE k NOT IN (SELECT c_nationkey FROM seed) GROUP BY k ORDER BY support DESC, k LIMIT 4)
    SELECT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey IN (SELECT k FROM r)""",
)
def enr05(t):
    """Nations in debt recommend other nations; the four best supported ones are read."""
    recommend = F.array(*[F.pmod(F.col("c_custkey") + n, F.lit(25)).cast("int") for n in (3, 11)])
    debtors = t.customer.filter((F.col("c_acctbal") < 0) & (F.col("c_nationkey") < 8))
    seed = debtors.select(F.col("c_nationkey").alias("s_nationkey"), recommend.alias("recommended"))
    return N.discover(seed, "recommended", t.supplier, "s_nationkey", 4).select("s_suppkey", "s_nationkey")


@query(
    "udf01_user_hooks",
    "SELECT conv_id, turn, len(string_split(text, chr(10))) AS lines FROM conversations WHERE role <> 'system'",
)
def udf01(t):
    def hook(record: dict):
        if record["role"] != "system":
            yield {"conv_id": record["conv_id"], "turn": record["turn"], "lines": len(record["text"].split("\n"))}

    return hooks.apply_hook(t.conversations, hook, "conv_id long, turn long, lines long")


@query("udf01_batch_hooks", "SELECT event_id, upper(event_type) AS kind, value * 2 AS doubled FROM events WHERE value >= 10")
def udf01_batches(t):
    """The hook gets whole Arrow batches."""
    def hook(batch: pa.RecordBatch) -> pa.Table:
        rows = pa.Table.from_batches([batch]).filter(pc.field("value") >= 10)
        return pa.table({"doubled": pc.multiply(rows["value"], 2), "kind": pc.utf8_upper(rows["event_type"]), "event_id": rows["event_id"]})

    return hooks.apply_batch_hook(t.events.select("event_id", "event_type", "value"), hook, "event_id long, kind string, doubled double")


@query(
    "udf01_line_udtf",
    "SELECT c_custkey AS uid, upper(c_name) AS name FROM customer WHERE c_acctbal >= 0",
)
def udf01_udtf(t):
    """A table function per fixed-width line, which may yield no row at all. It is called line by line, so an Arrow batch
    and a data frame for each call would be most of its cost."""
    @F.udtf(returnType="uid bigint, name string", useArrow=False)
    class ParseLine:
        def eval(self, line: str):
            if line[0] == "+":
                yield int(line[1:11]), line[11:].strip().upper()

    t.spark.udtf.register("parse_card_line", ParseLine)
    sign = F.when(F.col("c_acctbal") < 0, "-").otherwise("+")
    rows = t.customer.select(F.concat(sign, F.lpad(F.col("c_custkey").cast("string"), 10, "0"), F.rpad("c_name", 24, " ")).alias("line"))
    # a compact file is one or two splits, however many lines it has
    rows = rows.repartition(t.spark.sparkContext.defaultParallelism)
    return t.spark.sql("SELECT p.uid, p.name FROM {lines} l, LATERAL parse_card_line(l.line) p", lines=rows)
