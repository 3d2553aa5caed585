"""Row enrichment with a pluggable scorer, structured answers and discovery expansion.

A scorer is any function Column -> Column: a native expression or a pandas UDF around a model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import json_in_prose
from tidemark.operators.ordering import page
from tidemark.session import small_side


def within_budget(df: DataFrame, key: str, budget: int) -> tuple[DataFrame, DataFrame]:
    """(the first `budget` rows by key, the rest); rows without a key are in the rest. Rows with one key are ordered by
    a hash of their content, so a retry picks the same rows; of equal rows it does not matter which.

    One row is looked up, the last inside; a large budget orders only the slice of the keys that holds it."""
    rows = df.withColumns({"_key": F.col(key), "_hash": F.xxhash64(F.to_json(F.struct("*")))})
    keyed = rows.filter(F.col("_key").isNotNull())
    if budget <= 0:
        return df.filter(F.lit(False)), df
    cut = page(keyed.select("_key", "_hash"), ["_key", "_hash"], budget - 1, 1).first()
    if cut is None:
        return keyed.drop("_key", "_hash"), rows.filter(F.col("_key").isNull()).drop("_key", "_hash")
    at, level = F.lit(cut["_key"]).cast(df.schema[key].dataType), F.lit(cut["_hash"])
    before = (F.col("_key") < at) | ((F.col("_key") == at) & (F.col("_hash") < level))
    same = keyed.filter((F.col("_key") == at) & (F.col("_hash") == level))
    room = budget - keyed.filter(before).count()
    inside = keyed.filter(before).unionByName(same.limit(room))
    after = keyed.filter((F.col("_key") > at) | ((F.col("_key") == at) & (F.col("_hash") > level)))
    outside = after.unionByName(same.offset(room)).unionByName(rows.filter(F.col("_key").isNull()))
    return inside.drop("_key", "_hash"), outside.drop("_key", "_hash")


def enrich(df: DataFrame, key: str, budget: int, name: str, scorer: Callable[[Column], Column], source: str) -> DataFrame:
    """Score rows inside the budget; the others keep their row with a NULL answer."""
    inside, outside = within_budget(df, key, budget)
    scored = inside.withColumn(name, scorer(F.col(source)))
    kind = scored.schema[name].dataType
    return scored.unionByName(outside.withColumn(name, F.lit(None).cast(kind)))


def structured(answer: Column, schema: str) -> Column:
    """JSON object inside an answer as a struct; no JSON gives NULL fields."""
    return F.from_json(json_in_prose(answer), schema)


def allowed(value: Column, choices: list[str], default: str) -> Column:
    upper = F.upper(F.trim(value))
    return F.when(upper.isin(choices), upper).otherwise(F.lit(default))


def consensus(opinions: DataFrame, prefer: str = "first_opinion") -> DataFrame:
    """Agreed value, or the preferred side's where the two differ."""
    agreed = F.when(~F.col("disagree"), F.col("first_opinion")).otherwise(F.col(prefer))
    return opinions.withColumn("consensus", agreed)


def context_text(rows: DataFrame, keys: list[str], rank: str, line: Column, name: str) -> DataFrame:
    """Ranked rows (already limited to a top-K per key) rendered as one text per key."""
    items = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(rank), line.alias("line")))).alias("_l"))
    return items.select(*keys, F.array_join(F.transform("_l", lambda i: i["line"]), "\n").alias(name))


def discover(seed: DataFrame, recommendations: str, source: DataFrame, key: str, cap: int) -> DataFrame:
    """One hop: recommended keys not in the seed, the first `cap` by support, then their source rows."""
    proposed = seed.select(F.explode(recommendations).alias(key))
    ranked = proposed.groupBy(key).agg(F.count(F.lit(1)).alias("support")).join(seed.select(key).distinct(), key, "left_anti")
    chosen = ranked.orderBy(F.desc("support"), F.asc(key)).limit(cap)
    return source.join(small_side(chosen.select(key)), key, "left_semi")
