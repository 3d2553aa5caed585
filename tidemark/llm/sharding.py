"""Shards of equal row counts that cut few links, by balanced label propagation.

Linked rows form a star around their group, so a group of any size is as many links as it has rows. In each round a
group's rows are counted by shard, and its rows elsewhere ask to move to the shard that holds most of them. A shard
accepts as many as its quota leaves room for, in the order of the groups' hashes and whole groups first. Rows without links
have no say and fill what is left, so that counts are at most one apart in the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import own_columns, small, staged, text_or_empty
from tidemark.llm.numbering import by_ranges, numbered

SHARDS = 8
ROUNDS = 4
#: Linked rows may fill this share of a shard; the rest evens out the rounding.
FILL = 0.98
_LEVELS = 1024


def propagate(members: DataFrame, room: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """`members` (row, link, shard) with shards moved towards those of linked rows, at most `room` rows in each."""
    level = F.pmod(F.xxhash64("link"), F.lit(_LEVELS))
    chance = F.pmod(F.xxhash64("row", F.lit(7)), F.lit(1 << 20)) / (1 << 20)
    for _ in range(rounds):
        votes = members.groupBy("link", "shard").agg(F.count("*").alias("n"))
        best = votes.groupBy("link").agg((-F.max(F.struct("n", (-F.col("shard")).alias("s")))["s"]).alias("want"))
        asks = staged(members.join(small(staged(best, "best"), computed=True), "link"), "asks")
        moving = asks.where("shard <> want").groupBy(F.col("want"), level.alias("level")).agg(F.count("*").alias("n"))
        load = asks.groupBy(F.col("shard").alias("want")).agg(F.count("*").alias("load"))
        before = Window.partitionBy("want").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
        accepted = staged(
            moving.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).join(load, "want", "left")
            .select("want", "level", F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.lit(room) - F.coalesce("load", F.lit(0)) - F.col("ahead")) / F.col("n"))).alias("share")),
            "accepted")
        if accepted.where("share > 0").isEmpty():
            return asks.select("row", "link", "shard")
        # at most shards * _LEVELS rows
        moved = asks.withColumn("level", level).join(F.broadcast(accepted), ["want", "level"], "left")
        goes = (F.col("shard") != F.col("want")) & (chance < F.col("share"))
        members = staged(moved.select("row", "link", F.when(goes, F.col("want")).otherwise(F.col("shard")).alias("shard")), "members")
    return members


def shard_documents(df: DataFrame, shards: int = SHARDS) -> DataFrame:
    """For each row of `df` (doc_id, text; others ignored): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law `rows`: counts are at most one apart, the lower shards hold the larger ones. Equal texts are linked; a null
    text is empty, of size 1 and checksum 0. Rows are told apart by their place in the staged table, so null and
    repeated doc_ids are rows like others. An empty table gives no rows. `grown_shard` is null under this law.
    """
    text = text_or_empty()
    rows = own_columns(df, "doc_id", "text").select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("link"))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    total = rows.count()
    linked = staged(rows.groupBy("link").count().where("count > 1").select("link"), "linked")
    start = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")
    members = staged(rows.join(small(linked, computed=True), "link", "left_semi").select("row", "link", start), "members")
    placed = propagate(members, int(total // shards * FILL), shards)

    placed = staged(numbered(placed.select("row", "shard"), "shard", "row", "slot", total), "placed")
    load = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    taken = [min(load.get(s, 0), quota[s]) for s in range(shards)]
    settled = placed.where(F.col("slot") < F.element_at(F.array(*[F.lit(q).cast("long") for q in quota]), F.col("shard") + 1))
    marked = rows.join(settled, "row", "left")
    rest = staged(marked.where("shard IS NULL").select("row", F.lit(0).alias("all")), "rest")
    filler = numbered(rest, "all", "row", "turn", total)
    upto, bounds, shift = 0, [], []
    for s in range(shards):
        begin, upto = upto, upto + quota[s] - taken[s]
        bounds.append((upto, s))
        shift.append((upto, taken[s] - begin))
    filled = filler.select("row", by_ranges(F.col("turn"), bounds).cast("int").alias("fill"), (F.col("turn") + by_ranges(F.col("turn"), shift)).alias("fill_slot"))
    return marked.join(filled, "row", "left").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.coalesce("shard", "fill").alias("shard"),
        F.coalesce("slot", "fill_slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
