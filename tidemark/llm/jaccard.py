"""Documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, as connected components.

Exact, by multi-match prefixes: if two sets overlap by `o`, their first n - o + k tokens in one global order share at
least k. A first pass orders tokens by hash, takes prefixes so long that similar documents share many tokens, and asks
which prefix tokens occur elsewhere; a document with too few has no partner. For the others, tokens are ordered by how many of
these documents have them, rare first, and each document's prefix is lengthened as far as the estimated cost of its
candidates falls: a longer prefix asks for more shared tokens before two sets are compared. Candidates are pairs of a
document and a hub of a token's list; lists whose documents are in one component already are done, and the others go
on with their next hubs, more each round, so a group of near copies costs about as many comparisons as
it has members. Pairs whose sketches differ in more bits than sets of that similarity can are left out before; this
loses nothing. Near copies share many tokens of their prefixes, so of tokens that the same documents have, one list is made.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import own_columns, released, small, staged
from tidemark.llm.components import components
from tidemark.llm.exchange import Answers, Corpus
from tidemark.llm.rolling import Slices, Texts, U, mix

WORDS = 5
PERCENT = 80
#: In the first pass, similar documents share this part of a document's tokens within the prefixes.
FIRST_MATCH = 0.15
#: In the second pass, the longest extension, and tokens that cost as much to compare as one list entry to read.
MATCHES = 4
COMPARED = 16.0
#: Hubs that a list takes in one round, at most; all its documents are compared in as many rounds as it needs.
MOST_HUBS = 256
#: How many times as many each round takes.
HUBS_GROW = 8
#: Bits of a set's sketches: the parities of how many of its shingles fall to each. The short one goes with every list
#: entry, the long one is looked up for candidate pairs, before their sets are.
SKETCH_BITS = 512
LONG_SKETCH_BITS = 4096

SCHEMA = "doc_id long, text_md5 string, n_shingles long, class long, alone boolean, tokens array<long>, sketch array<long>, long_sketch array<long>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("text_md5", pa.string()), ("n_shingles", pa.int64()), ("class", pa.int64()), ("alone", pa.bool_()), ("tokens", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())), ("long_sketch", pa.list_(pa.int64()))])


def _least_overlap(n: int) -> int:
    return -(-PERCENT * n // 100)


def _sets(texts: Texts) -> list[np.ndarray]:
    """Each text's distinct shingles, as sorted hashes."""
    words, _, _, begins = texts.words(lower=True)
    slices = Slices(words)
    shingles = slices.every(WORDS)
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(shingles[a : b - WORDS + 1]))
        elif b > a:
            out.append(slices.of(np.array([a]), np.array([b])))
        else:
            out.append(np.zeros(0, U))
    return out


def _sketch(s: np.ndarray, size: int) -> np.ndarray:
    """Parities of a set's shingles: two sets differ in at least as many shingles as their sketches do in bits."""
    odd = np.bincount((mix(s) % U(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _items(sets: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of each set, a hash of the whole and the tokens of its prefix."""
    whole = np.array([mix(np.array([s.size], U) + mix(s).sum(dtype=U))[0] for s in sets], U)
    prefixes = [mix(s[: s.size - _least_overlap(s.size) + int(FIRST_MATCH * s.size) + 1]) for s in sets]
    return whole, prefixes


def _asked(texts: Texts, answers: list[Answers]) -> np.ndarray:
    whole, prefixes = _items(_sets(texts))
    return np.concatenate([whole, *prefixes]) if len(whole) else whole


def _finish(ids: list, texts: Texts, answers: list[Answers]) -> dict:
    sets = _sets(texts)
    whole, prefixes = _items(sets)
    shared, first = answers[0].about(np.concatenate([whole, *prefixes]))
    data, o = texts.data.tobytes(), texts.offsets.tolist()
    out = {f.name: [] for f in _ARROW}
    at = len(sets)
    for k, s in enumerate(sets):
        found = int(shared[at : at + len(prefixes[k])].sum())
        at += len(prefixes[k])
        # a partner has at least the least overlap as its size
        wanted = int(FIRST_MATCH * _least_overlap(s.size)) + 1
        out["doc_id"].append(ids[k])
        out["text_md5"].append(hashlib.md5(data[o[k] : o[k + 1]]).hexdigest())
        out["n_shingles"].append(s.size)
        out["class"].append(int(whole[k : k + 1].view(np.int64)[0]) if s.size else None)
        out["alone"].append(not (s.size and shared[k]) and found < wanted)
        asked = s.size and first[k] and found >= wanted
        out["tokens"].append(s.view(np.int64) if asked else None)
        out["sketch"].append(_sketch(s, SKETCH_BITS) if asked else None)
        out["long_sketch"].append(_sketch(s, LONG_SKETCH_BITS) if asked else None)
    return out


def _prefixes(sets: DataFrame) -> DataFrame:
    """row, n, weight, matches and prefix of `sets` (row, n, tokens); those that can have no partner are left out. Staged."""
    tokens = sets.select("row", F.explode("tokens").alias("token"))
    often = staged(tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1"), "frequencies")
    ordered = tokens.join(often, "token").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("ranked"))
    overlap = F.ceil(F.col("n") * PERCENT / F.lit(100.0))
    # tokens of one document only come first in the order and match nothing
    plain = F.col("n") - overlap + 1 - (F.col("n") - F.size("ranked"))
    reach = [F.expr(f"aggregate(slice(ranked, 1, plain + {k}), 0D, (a, t) -> a + t.often - 1)") for k in range(MATCHES)]
    costs = [s * (1 + F.col("n") / (COMPARED * (k + 1))) for k, s in enumerate(reach)]
    best = F.least(*[F.struct(c.alias("cost"), F.lit(k + 1).alias("matches")) for k, c in enumerate(costs)])
    ranked = (
        sets.select("row", "n").join(ordered, "row").withColumn("overlap", overlap).withColumn("plain", plain.cast("int"))
        .where((F.col("plain") > 0) & (F.size("ranked") >= F.col("overlap"))).withColumn("matches", best["matches"]))
    out = staged(ranked.select(
        "row", "n", "matches", F.expr("aggregate(ranked, 0L, (a, t) -> a + t.often)").alias("weight"),
        F.expr("transform(slice(ranked, 1, plain + matches - 1), t -> t.token)").alias("prefix")), "prefixes")
    released(often)
    return out


def _lists(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """token, row, n, weight, component and sketch for the tokens that more than one row of `docs` has in its prefix; of
    tokens that the same rows have, one, as their lists hold the same pairs. Staged."""
    entries = docs.select(F.explode("prefix").alias("token"), "row", "n", "weight", F.col("row").alias("component"))
    # rows of a token are distinct, so two parities of their hashes and their number tell the set
    digests = [F.bit_xor(F.xxhash64("row", F.lit(k))).alias(f"digest{k}") for k in range(2)]
    spans = entries.groupBy("token").agg(F.count("*").alias("often"), *digests).where("often > 1")
    kept = staged(spans.groupBy("often", "digest0", "digest1").agg(F.min("token").alias("token")).select("token"), "list_tokens")
    lists = staged(entries.join(small(kept, computed=True), "token", "left_semi").join(sets.select("row", "sketch"), "row"), "lists")
    released(kept)
    return lists


def _similar(pairs: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of `pairs` (row, hub, component, hub_component), the components (a, b) of those whose sets are similar. Staged.

    Long sketches leave out nearly all pairs below the similarity, so sets are fetched for few others."""

    def in_pairs(found: DataFrame, rows: DataFrame) -> DataFrame:
        # so that rows in no pair are not shuffled
        named = found.select("row").unionAll(found.select("hub")).distinct()
        return rows.join(small(named, computed=True), "row", "left_semi")

    def with_both(found: DataFrame, rows: DataFrame) -> DataFrame:
        theirs = rows.select(*[F.col(c).alias("hub" if c == "row" else f"hub_{c}") for c in rows.columns])
        return found.join(rows, "row").join(theirs, "hub")

    differ = F.expr("aggregate(zip_with(long_sketch, hub_long_sketch, (x, y) -> bit_count(x ^ y)), 0, (a, b) -> a + b)")
    sketches = in_pairs(pairs, sets.select("row", "n", "long_sketch"))
    near = with_both(pairs, sketches).where(_allowed(differ, F.col("n") + F.col("hub_n"))).drop("long_sketch", "hub_long_sketch")
    both = F.size(F.array_intersect("tokens", "hub_tokens"))
    near = staged(near, "near")
    whole = in_pairs(near, sets.select("row", "tokens")).join(in_pairs(near, docs.select("row", "matches", "prefix")), "row")
    met = with_both(near, whole).where(F.size(F.array_intersect("prefix", "hub_prefix")) >= F.least("matches", "hub_matches"))
    alike = met.where(100 * both >= PERCENT * (F.col("n") + F.col("hub_n") - both))
    links = staged(alike.select(F.col("component").alias("a"), F.col("hub_component").alias("b")).distinct(), "links")
    released(near)
    return links


def _marks(lists: DataFrame, hubs_each: int) -> DataFrame:
    """For each token whose list is in more than one component: its next hubs, heaviest first. Staged."""
    spans = lists.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    # the rank filter is applied before the shuffle too, so a long list is not gathered
    place = F.row_number().over(Window.partitionBy("token").orderBy(F.desc("weight"), F.asc("row")))
    tops = lists.withColumn("place", place).where(F.col("place") <= hubs_each).groupBy("token").agg(
        F.collect_list(F.struct("row", "n", "weight", "component", "sketch")).alias("hubs"))
    return staged(spans.join(tops, "token"), "marks")


def _allowed(differ: Column, sizes: Column) -> Column:
    """Whether two sets that differ in at least so many shingles can have the similarity."""
    return (100 + PERCENT) * differ <= (100 - PERCENT) * sizes


def _near(hub: Column) -> Column:
    """Whether the short sketches allow the similarity."""
    bits = sum((F.bit_count(F.get("sketch", F.lit(i)).bitwiseXOR(F.get(hub["sketch"], F.lit(i)))) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return _allowed(bits, F.col("n") + hub["n"])


def _renamed(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """`df` with the components in `column` named by `labels` (node, label); those without a label stay."""
    others = [c for c in df.columns if c != column]
    return df.join(labels, F.col(column) == F.col("node"), "left").select(*others, F.coalesce("label", column).alias(column))


def _labels(sets: DataFrame) -> DataFrame:
    """(row, label) for the rows of `sets` that can have a partner: rows have one label if similarity connects them."""
    docs = _prefixes(sets)
    known = docs.select("row", F.col("row").alias("label"))
    lists = _lists(docs, sets)
    hubs_each = 1
    while True:
        marks = _marks(lists, hubs_each)
        if marks.isEmpty():
            return known
        marked = lists.join(small(marks, computed=True), "token")
        wanted = F.filter("hubs", lambda h: (
            ((F.col("weight") < h["weight"]) | (F.col("weight") == h["weight"]) & (F.col("row") > h["row"]))
            & (100 * F.least(F.col("n"), h["n"]) >= PERCENT * F.greatest(F.col("n"), h["n"])) & (F.col("component") != h["component"])
            & _near(h)))
        # a pair is met in many lists; each row's hubs are put together before they become pairs
        ids = F.transform(wanted, lambda h: F.struct(h["row"].alias("hub"), h["component"].alias("hub_component")))
        met = marked.select("row", "component", ids.alias("ids")).where(F.size("ids") > 0).groupBy("row", "component").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"))
        pairs = staged(met.select("row", "component", F.explode("ids").alias("h")).select("row", "component", "h.*"), "pairs")
        new = _similar(pairs, docs, sets)
        # lists in one component have no mark and are done
        rest = marked.where(~F.array_contains("hubs.row", F.col("row"))).drop("hubs")
        if not new.isEmpty():
            labels = small(components(new), computed=True)
            known = staged(known.select("row", F.col("label").alias("component")).transform(_renamed, "component", labels).withColumnRenamed("component", "label"), "known")
            rest = _renamed(rest, "component", labels)
        rest = staged(rest, "lists")
        released(lists, marks, pairs, new)
        lists = rest
        hubs_each = min(HUBS_GROW * hubs_each, MOST_HUBS)


def similar_documents(df: DataFrame) -> DataFrame:
    """For each row of `df` (doc_id, text; others ignored): doc_id, n_shingles, component_id, text_md5, n_same.

    A-Z are lower-cased; a text of fewer than five words is one shingle; a null, empty or blank text has none and is
    linked with nothing. component_id is the smallest doc_id that links reach; rows with null doc_id link like others
    and are never that smallest one, unless alone. n_same is how many rows have the same set. Repeated rows are rows
    of one class. An empty table gives no rows.
    """
    corpus = Corpus(df)
    corpus.ask(_asked)
    rows = corpus.each(_finish, SCHEMA, _ARROW)
    alone = rows.where("alone").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_md5", F.lit(1).cast("long").alias("n_same"))
    others = rows.where("NOT alone").drop("tokens", "sketch", "long_sketch", "alone")
    corpus.release()
    sets = rows.where("tokens IS NOT NULL").select("row", F.col("n_shingles").alias("n"), "tokens", "sketch", "long_sketch")
    labels = _labels(sets)
    classes = others.groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_same"))
    linked = rows.where("tokens IS NOT NULL").select("class", "row").join(labels, "row").select("class", "label")
    labelled = staged(classes.join(linked, "class", "left"), "classes")
    tops = labelled.where("label IS NOT NULL").groupBy("label").agg(F.min("least").alias("top"))
    classes = labelled.join(small(tops), "label", "left").select("class", "n_same", F.coalesce("top", "least").alias("component_id"))
    named = others.join(small(staged(classes, "named"), computed=True), "class")
    return alone.unionByName(named.select("doc_id", "n_shingles", "component_id", "text_md5", "n_same"))


def without_near_copies(df: DataFrame) -> DataFrame:
    """The rows of `df` (doc_id, text, ...) whose doc_id is the smallest of their component, with all their columns."""
    found = similar_documents(df).where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = small(staged(found.select(F.col("doc_id").alias("_doc"), F.col("text_md5").alias("_md5")).distinct(), "near_copies"), computed=True)
    text = F.coalesce(F.col("text"), F.lit(""))
    return df.join(gone, (F.col("_md5") == F.md5(text.cast("binary"))) & F.col("_doc").eqNullSafe(F.col("doc_id")), "left_anti")
