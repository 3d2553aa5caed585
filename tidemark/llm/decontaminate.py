"""Documents that hold a passage of a benchmark, by SimHash over windows of the items' own lengths.

A window has as many words as an item. Windows that share too few shingle places with an item to reach the threshold
are left out before (this loses nothing: the shared places bound the overlap). The others and the items get 64-bit SimHash
fingerprints; a multi-index cuts those into one block more than the radius, so fingerprints within the radius agree in
a block, and all such pairs are found. Each is then checked by the exact weighted Jaccard similarity of its shingles.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import SPACE_CLASS, own_columns, small, staged, text_or_empty

WORDS = 5
PERCENT = 80
#: Hamming distance. Sets of similarity 0.8 differ by 9.7 of 64 bits on average, with a deviation of 2.9.
RADIUS = 24


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), f"{SPACE_CLASS}+"), lambda w: w != "")


def _shingles(size: int, text: Column) -> Column:
    """All runs of `size` words of the text, as structs (place, total, shingle hash). The array of word hashes is bound
    to a lambda's variable, as it would be computed again for each word otherwise."""
    hashes = F.transform(_words(text), lambda w: F.xxhash64(w))

    def runs(hs: Column) -> Column:
        total = F.greatest(F.size(hs) - size + 1, F.lit(0))
        run = F.transform(hs, lambda _, i: F.struct(i.alias("place"), total.alias("total"), F.xxhash64(*[F.get(hs, i + k) for k in range(size)]).alias("shingle")))
        return F.slice(run, F.lit(1), total)

    return F.get(F.transform(F.array(hashes), runs), F.lit(0))


def _items(benchmark: DataFrame) -> DataFrame:
    """item, item_id, gram (words in a shingle), length (shingles in the item), shingles. Staged."""
    rows = own_columns(benchmark, "item_id", "text").withColumn("item", F.xxhash64("item_id", "text")).dropDuplicates(["item"])
    text = text_or_empty()
    counted = staged(rows.withColumn("gram", F.least(F.size(_words(text)), F.lit(WORDS))).where("gram > 0"), "items")
    lists = None
    for gram in range(1, WORDS + 1):
        own = counted.where(F.col("gram") == gram).select("item", "item_id", "gram", _shingles(gram, text).alias("shingles"))
        lists = own if lists is None else lists.unionAll(own)
    return staged(lists.select("item", "item_id", "gram", F.col("shingles.shingle").alias("shingles"), F.size("shingles").alias("length")), "items")


def _places(docs: DataFrame, grams: list[int]) -> DataFrame:
    """All shingles of `docs` (doc_id, text): key, gram, place, total, shingle."""
    out = None
    for gram in grams:
        rows = docs.select(F.xxhash64("doc_id", "text").alias("key"), F.lit(gram).alias("gram"), F.inline(_shingles(gram, text_or_empty())))
        out = rows if out is None else out.unionAll(rows)
    return out


def _fingerprints(rows: DataFrame, *keys: str) -> DataFrame:
    """`keys` and the SimHash of their `shingle`s; two bit counts to a number, 32 bits each. A text has less than 2^31
    bytes, so neither count overflows."""
    lanes = [F.sum(F.expr(f"shiftright(shingle, {q}) & {1 << 32 | 1}L")).alias(f"lane{q}") for q in range(32)]
    sums = rows.groupBy(*keys).agg(F.count("*").alias("n"), *lanes)
    counts = [f"lane{q} & {(1 << 32) - 1}L" for q in range(32)] + [f"shiftright(lane{q}, 32)" for q in range(32)]
    bits = [f"IF(2 * ({count}) > n, shiftleft(1L, {i}), 0L)" for i, count in enumerate(counts)]
    return sums.select(*keys, F.expr(" | ".join(bits)).alias("fingerprint"))


def _blocks(rows: DataFrame, radius: int) -> DataFrame:
    """A row for each of the radius + 1 blocks of a fingerprint: block, bits."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    parts = [F.struct(F.lit(i).alias("block"), F.expr(f"shiftright(fingerprint, {a}) & {(1 << (b - a)) - 1}L").alias("bits")) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:]))]
    return rows.withColumn("part", F.explode(F.array(*parts))).select("*", "part.*").drop("part")


def leaks(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """key, item_id, similarity: for each document's key and each benchmark item, the most similar window of at least
    `percent`. The key is xxhash64(doc_id, text)."""
    items = _items(benchmark)
    grams = [r["gram"] for r in items.select("gram").distinct().orderBy("gram").collect()] or [WORDS]  # 1 to 5
    item_shingles = staged(items.select("item", "gram", "length", F.explode("shingles").alias("shingle")).groupBy("item", "gram", "length", "shingle").agg(F.count("*").alias("weight")), "item_shingles")
    docs = own_columns(documents, "doc_id", "text")
    wanted = small(item_shingles.select("item", "gram", "length", "shingle"), computed=True)
    hits = staged(_places(docs, grams).join(wanted, ["gram", "shingle"]).select("key", "item", "gram", "length", "total", "place").distinct(), "hits")

    # a window within the threshold has this many places that hit the item
    enough = F.col("n") * 100 >= F.col("length") * percent
    likely = hits.groupBy("key", "item").agg(F.count("*").alias("n"), F.first("length").alias("length")).where(enough).select("key", "item")
    last = F.greatest(F.col("total") - F.col("length"), F.lit(0))
    first_start, last_start = F.greatest(F.col("place") - F.col("length") + 1, F.lit(0)), F.least(F.col("place"), last)
    starts = (
        hits.join(small(staged(likely, "likely"), computed=True), ["key", "item"]).where(first_start <= last_start)
        .withColumn("start", F.explode(F.sequence(first_start, last_start)))
        .groupBy("key", "item", "gram", "length", "start").agg(F.count("*").alias("n")).where(enough))
    windows = staged(starts.select("key", "gram", "length", "start").distinct(), "windows")
    keys = small(staged(windows.select("key").distinct(), "keys"), computed=True)

    # only documents with such windows are read again; copies with one key have the same windows
    again = docs.join(keys, F.xxhash64("doc_id", "text") == F.col("key"), "left_semi").dropDuplicates()
    inside = _places(again, grams).join(windows, ["key", "gram"]).where("place >= start AND place < start + length")
    inside = staged(inside.select("key", "gram", "length", "start", "shingle"), "inside")
    prints = staged(_fingerprints(inside, "key", "gram", "length", "start"), "prints")
    item_prints = _fingerprints(items.select("item", "gram", "length", F.explode("shingles").alias("shingle")), "item", "gram", "length").withColumnRenamed("fingerprint", "item_print")
    item_blocks = staged(_blocks(item_prints.withColumnRenamed("item_print", "fingerprint"), radius).withColumnRenamed("fingerprint", "item_print"), "item_blocks")
    pairs = (
        _blocks(prints, radius).join(small(item_blocks, computed=True), ["gram", "length", "block", "bits"])
        .where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= radius)
        .select("key", "gram", "length", "start", "item").distinct())

    counts = inside.groupBy("key", "gram", "length", "start", "shingle").agg(F.count("*").alias("n"))
    size = inside.groupBy("key", "gram", "length", "start").agg(F.count("*").alias("size"))
    pairs = staged(pairs.join(size, ["key", "gram", "length", "start"]), "candidates")
    common = pairs.join(counts, ["key", "gram", "length", "start"]).join(small(item_shingles.drop("gram", "length"), computed=True), ["item", "shingle"])
    both = common.groupBy("key", "item", "start", "length", "size").agg(F.sum(F.least("n", "weight")).alias("both"))
    union = F.col("size") + F.col("length") - F.col("both")
    found = both.where(F.col("both") * 100 >= union * percent).groupBy("key", "item").agg(F.max(F.col("both") / union).alias("similarity"))
    return found.join(small(items.select("item", "item_id"), computed=True), "item").select("key", "item_id", "similarity")


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For each row of `documents` (doc_id, text; others ignored): doc_id, contaminated, n_items, item_id, similarity.

    Words are lower-cased and cut at ASCII white space; shingles have five words, an item of fewer is one shingle. A
    document shorter than an item is one window. Null and empty texts, of documents or items, match nothing. item_id
    is that of the most similar item, of tied ones the smallest, null if there is none; similarity is 0 then. Repeated
    rows get the same answer; a null doc_id is a value like others. Empty tables give no rows, or clean ones.
    """
    found = leaks(documents, benchmark).groupBy("key").agg(F.count("*").alias("n_items"), F.min(F.struct((-F.col("similarity")).alias("worse"), "item_id")).alias("best"))
    rows = own_columns(documents, "doc_id", "text").select("doc_id", F.xxhash64("doc_id", "text").alias("key"))
    return rows.join(small(staged(found, "leaks"), computed=True), "key", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.col("best.item_id").alias("item_id"), F.coalesce(-F.col("best.worse"), F.lit(0.0)).alias("similarity"))


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `documents` that hold no benchmark passage, with all their columns."""
    gone = small(staged(leaks(documents, benchmark).select(F.col("key").alias("_key")).distinct(), "leaks"), computed=True)
    return documents.join(gone, F.col("_key") == F.xxhash64("doc_id", "text"), "left_anti")
