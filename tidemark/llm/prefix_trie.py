"""A trie of conversation prefixes as a distributed burst trie.

Conversations with equal turns are one sequence with a count, so copies cost one member. All sequences start in one
container under the root. In each round the containers that hold too many turns burst: their sequences move to
containers under new heads, by their next turn id (from the third round by their next 2, 4, 8, ... turn ids at once, so
a long shared prefix takes few rounds). Containers that are small enough are sorted by their suffixes, and one pass over
each partition's containers makes their nodes, holding one container's nodes at a time. A suffix alone in its container is a
chain and needs no sweep. The heads' totals are added up from the containers' along the heads of one member.

A turn id is 128 bits of hash of role and text. Turns are numbered on a range partitioning, so that no task holds a
whole conversation, however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import own_columns, small, staged
from tidemark.operators.ordering import running_total

#: Turns that a container may hold; larger ones burst. A single sequence never bursts.
CONTAINER_TURNS = 8192
#: Conversations whose first turns are shared, and how many turns at most.
FAMILY, SHARED = 20, 4
#: Ids that are put together before they are hashed in order.
CHUNK = 4096
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_rep", "end_n"]
_SWEPT = ", ".join(f"{c} long" for c in [*_NODE, "a", "b"])
_LONG = pa.int64()


def _numbered(df: DataFrame) -> DataFrame:
    """conv, pos (from 0), ta, tb (turn id), words. Staged."""
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")]
    rows = own_columns(df, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.xxhash64(role, text).alias("ta"), F.xxhash64(F.lit(1), text, role).alias("tb"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = ["conv", F.asc_nulls_first("turn"), "ta", "tb"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, place = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for c in batch.column("conv").to_pylist():
                place = place + 1 if c == conv else 0
                conv = c
                places.append(place)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(places), pa.int32()), pa.array(places, _LONG), *[batch.column(n) for n in ("conv", "ta", "tb", "words")]],
                ["part", "place", "conv", "ta", "tb", "words"])

    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(sorted_rows.mapInArrow(number, "part int, place long, conv long, ta long, tb long, words long"), "turns")
    edges = placed.groupBy("part").agg(F.min("conv").alias("low"), F.max("conv").alias("high"))
    counts = placed.join(F.broadcast(edges), "part").where("conv IN (low, high)").groupBy("part", "conv").count()
    # at most two rows for each partition: only their first conversation can go on from an earlier one
    before, seen = [], {}
    for r in sorted(counts.collect()):
        if r.conv in seen:
            before.append((r.part, r.conv, seen[r.conv]))
        seen[r.conv] = seen.get(r.conv, 0) + r["count"]
    offsets = df.sparkSession.createDataFrame(before, "part int, conv long, offset long")
    joined = placed.join(F.broadcast(offsets), ["part", "conv"], "left")
    return joined.select("conv", (F.col("place") + F.coalesce("offset", F.lit(0))).alias("pos"), "ta", "tb", "words")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv), and the rebuilt turns: conv, pos, ta, tb, words. Staged."""
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(SHARED))
    convs = turns.select("conv").where("pos = 0")
    base = F.col("conv") - F.col("conv") % FAMILY
    # fewer than SHARED turns for each base
    first = turns.where((F.col("pos") < SHARED - 1) & (base == F.col("conv"))).groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "ta", "tb", "words"))).alias("first"))
    started = staged(convs.select("conv", base.alias("base"), h.alias("h")).join(first, "base", "left").select(
        "conv", "h", F.slice(F.coalesce("first", F.array().cast(first.schema["first"].dataType)), F.lit(1), F.col("h").cast("int")).alias("start")), "starts")
    # a base with fewer turns than are shared pulls the own turns forward
    moved = started.where(F.size("start") < F.col("h")).select("conv", (F.size("start") - F.col("h")).alias("shift"))
    own = turns.where(F.col("pos") >= h).join(small(moved), "conv", "left").withColumn("pos", F.col("pos") + F.coalesce("shift", F.lit(0))).drop("shift")
    shared = started.select("conv", F.explode("start").alias("t")).select("conv", "t.*")
    return started.select("conv"), staged(own.select(*shared.columns).unionByName(shared), "rebuilt")


def _mark(column: str) -> Column:
    return F.bit_xor(F.xxhash64("pos", column))


def _sequences(convs: DataFrame, rebuilt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (conv, rep) of the sequences that several conversations have, and all sequences: rep (their smallest
    conversation), n, turns. Staged."""
    marks = rebuilt.groupBy("conv").agg(F.count("*").alias("turns"), _mark("ta").alias("ma"), _mark("tb").alias("mb"))
    marked = staged(convs.join(marks, "conv", "left").fillna(0), "marks")
    keys = ["turns", "ma", "mb"]
    sequences = staged(marked.groupBy(*keys).agg(F.min("conv").alias("rep"), F.count("*").alias("n")), "sequences")
    members = marked.join(small(sequences.where("n > 1"), computed=True), keys).select("conv", "rep")
    return members, sequences.select("rep", "n", "turns")


def _digests(members: DataFrame) -> DataFrame:
    """rep, ends_sha256: of a sequence's ids in order. Ids are joined to pieces by many tasks, the pieces hashed as they come."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rep, digest = None, None
        for batch in batches:
            reps, sums = [], []
            for r, piece in zip(batch.column("rep").to_pylist(), batch.column("piece").to_pylist()):
                if r != rep:
                    if digest:
                        reps.append(rep)
                        sums.append(digest.hexdigest())
                    rep, digest = r, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array(reps, _LONG), pa.array(sums, pa.string())], ["rep", "ends_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([rep], _LONG), pa.array([digest.hexdigest()])], ["rep", "ends_sha256"])

    # at most CHUNK different ids fall in one piece
    chunk = F.floor(F.col("conv") / CHUNK).cast("long").alias("chunk")
    pieces = members.groupBy("rep", chunk).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("piece"))
    return pieces.repartition("rep").sortWithinPartitions("rep", "chunk").select("rep", "piece").mapInArrow(hashed, "rep long, ends_sha256 string")


def _burst(turns: DataFrame, sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths: rep, n, turns, depth, the head (a, b) at that depth, its parent head (pa, pb) and the words of its last turn.
    Containers: rep, n, turns, the head (a, b), its depth, and how many sequences share it. Staged."""
    zero = F.lit(0).cast("long")
    active = staged(sequences.select("rep", "n", "turns", zero.alias("a"), zero.alias("b")), "root")
    paths = active.select("*", zero.alias("depth"), zero.alias("pa"), zero.alias("pb"), zero.alias("words"))
    done, depth, stride, rounds = None, 0, 1, 0
    while True:
        sizes = active.groupBy("a", "b").agg(F.sum(F.col("turns") - depth).alias("rest"), F.count("*").alias("members"))
        sizes = sizes.select("a", "b", "members", ((F.col("rest") > CONTAINER_TURNS) & (F.col("members") > 1)).alias("bursts"))
        placed = staged(active.join(small(sizes), ["a", "b"]).withColumn("depth", F.lit(depth).cast("long")), "containers")
        kept = placed.where("NOT bursts").drop("bursts")
        done = kept if done is None else done.unionByName(kept)
        active = placed.where("bursts").select("rep", "n", "turns", "a", "b")
        if active.isEmpty():
            return paths, done
        here = turns.where((F.col("pos") >= depth) & (F.col("pos") < depth + stride)).join(small(active, computed=True), "rep")
        run = Window.partitionBy("rep").orderBy("pos")
        ka, kb = (F.xxhash64("pos", "ta"), F.xxhash64("pos", "tb")) if stride == 1 else (_mark("ta").over(run), _mark("tb").over(run))
        keyed = here.select("rep", "n", "turns", "pos", "words", F.col("a").alias("ha"), F.col("b").alias("hb"), ka.alias("ka"), kb.alias("kb")).select(
            "*", F.xxhash64("ha", "hb", "ka", "pos").alias("a"), F.xxhash64(F.lit(1), "hb", "ha", "kb", "pos").alias("b"))
        above = [F.col("ha"), F.col("hb")] if stride == 1 else [F.coalesce(F.lag(c, 1).over(run), F.col(p)) for c, p in (("a", "ha"), ("b", "hb"))]
        new = staged(keyed.select("rep", "n", "turns", "a", "b", (F.col("pos") + 1).alias("depth"), above[0].alias("pa"), above[1].alias("pb"), "words"), "heads")
        paths = paths.unionByName(new)
        depth, rounds = depth + stride, rounds + 1
        active = new.where(F.col("depth") == depth).select("rep", "n", "turns", "a", "b")
        stride *= 1 if rounds < 2 else 2


class _Node:
    """A node on the way from the head to the last suffix; `below` are finished children that wait for its smallest member."""

    __slots__ = ("words", "rep", "n", "end", "end_n", "kids", "leaves", "saved", "below")

    def __init__(self, words: int):
        self.words, self.rep, self.n, self.end, self.end_n, self.kids, self.leaves, self.saved, self.below = words, None, 0, None, None, 0, 0, 0, []

    def add(self, rep: int, n: int) -> None:
        self.rep, self.n = rep if self.rep is None else min(rep, self.rep), self.n + n


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers, each with its suffixes in order, to nodes; one row with a head's own columns for each container."""
    head, base, path, last, out = None, 0, [], [], []

    def close(depth: int) -> None:
        """Finish the nodes below this depth of the path; the head is path[0]."""
        while len(path) > depth + 1:
            node, parent = path.pop(), path[-1]
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.words
            mine = base + len(path)
            out.extend((c[0], c[1], node.rep, *c[2:], None, None) for c in node.below)
            parent.below.append((node.rep, mine, node.n, node.kids, node.leaves, node.saved, node.end, node.end_n))
            parent.add(node.rep, node.n)
            parent.kids, parent.leaves, parent.saved = parent.kids + 1, parent.leaves + node.leaves, parent.saved + node.saved

    def finish() -> None:
        close(0)
        top = path.pop()
        out.extend((c[0], c[1], top.rep, *c[2:], None, None) for c in top.below)
        out.append((top.rep, base, None, top.n, top.kids, top.leaves or 1, top.saved, top.end, top.end_n, *head))

    for batch in batches:
        for a, b, depth, rep, n, suffix in zip(*[batch.column(k).to_pylist() for k in ("a", "b", "depth", "rep", "n", "suffix")]):
            if (a, b) != head:
                if path:
                    finish()
                head, base, path, last = (a, b), depth, [_Node(0)], []
            ids = [(t["ta"], t["tb"]) for t in suffix]
            common = 0
            for x, y in zip(ids, last):
                if x != y:
                    break
                common += 1
            close(common)
            path.extend(_Node(t["words"]) for t in suffix[common:])
            path[-1].end, path[-1].end_n = rep, n
            path[-1].add(rep, n)
            last = ids
        yield _batch(out)
        out = []
    if path:
        finish()
    yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [*_NODE, "a", "b"]
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _LONG) for c in columns], names)


def _chains(tails: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of the sequences that are alone in their containers, without gathering them."""
    rows = turns.join(tails, "rep").where("pos >= depth").select("rep", "n", "turns", "pos", "words")
    # only sequences that several conversations have save tokens: from a node on, the words of its turns
    weighted = rows.where("n > 1").withColumn("back", -F.col("pos"))
    saved = running_total(weighted, ["rep"], ["back"], F.floor(F.col("back") / CONTAINER_TURNS), (F.col("n") - 1) * F.col("words"), "saved").drop("back")
    every = saved.unionByName(rows.where("n = 1").withColumn("saved", F.lit(0).cast("long")))
    last, none = F.col("pos") + 1 == F.col("turns"), F.lit(None).cast("long")
    return every.select(
        F.col("rep").alias("conv_id"), (F.col("pos") + 1).alias("depth"), F.col("rep").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.when(last, F.col("rep")).alias("end_rep"), F.when(last, F.col("n")).alias("end_n"), none.alias("a"), none.alias("b"))


def _heads(paths: DataFrame, tops: DataFrame) -> DataFrame:
    """The heads' nodes, from the paths through them and what lies in the containers below (a, b, kids, leaves, saved)."""
    ends = F.col("turns") == F.col("depth")
    nodes = staged(paths.groupBy("a", "b", "depth", "pa", "pb").agg(
        F.min("rep").alias("conv_id"), F.sum("n").alias("n_convs"), F.max("words").alias("words"),
        F.max(F.when(ends, F.col("rep"))).alias("end_rep"), F.max(F.when(ends, F.col("n"))).alias("end_n")), "head_nodes")
    under = nodes.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("heads"))
    full = nodes.join(under, ["a", "b"], "left").join(tops, ["a", "b"], "left").withColumn("n_children", F.coalesce("kids", "heads", F.lit(0)))
    full = staged(full.select(
        *nodes.columns, "n_children", F.coalesce("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0)).cast("long").alias("own_leaves"),
        ((F.col("n_convs") - 1) * F.col("words") + F.coalesce("saved", F.lit(0))).alias("own_saved")), "head_totals")
    # a head's smallest member passes all heads above it
    ways = paths.select("rep", "a", "b", F.col("depth").alias("above"))
    totals = full.select(F.col("conv_id").alias("rep"), "depth", "own_leaves", "own_saved").join(ways, "rep").where("above <= depth").groupBy("a", "b").agg(
        F.sum("own_leaves").alias("n_leaves"), F.sum("own_saved").alias("saved_tokens"))
    parents = full.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("above_id"))
    out = full.join(totals, ["a", "b"]).join(parents, ["pa", "pb"])
    return out.withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("above_id"))).select(*_NODE)


def prefix_trie(df: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations of `df` (conv_id, turn, role, text;
    others ignored): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are in order of `turn`, null first; turns with the same number are ordered by their ids, so repeated rows are turns of
    their own in a fixed order. Null role or text is empty. Rows without conv_id are in no conversation. Conversations that
    are rebuilt to no turn are members of the root. An empty table has no root and gives no rows.
    """
    convs, rebuilt = _rebuilt(_numbered(df))
    members, sequences = _sequences(convs, rebuilt)
    turns = staged(rebuilt.withColumnRenamed("conv", "rep").join(small(sequences.select("rep"), computed=True), "rep", "left_semi"), "sequence_turns")
    paths, containers = _burst(turns, sequences)
    chain = (F.col("members") == 1) & ((F.col("n") == 1) | (F.col("turns") - F.col("depth") > CONTAINER_TURNS))
    alone, shared = containers.where(chain).drop("members"), containers.where(~chain).drop("members")
    # a container has a bounded number of turns
    suffixes = turns.join(shared.select("rep", "depth"), "rep").where("pos >= depth").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("pos", "ta", "tb", "words"))).alias("suffix"))
    empty = F.array().cast(suffixes.schema["suffix"].dataType)
    filled = shared.join(suffixes, "rep", "left").withColumn("suffix", F.coalesce("suffix", empty))
    swept = staged(filled.repartition("a", "b").sortWithinPartitions("a", "b", "suffix").mapInArrow(_sweep, _SWEPT), "swept")
    chains = staged(_chains(alone, turns), "chains")
    after = chains.join(alone.select("rep", F.col("depth").alias("head"), "a", "b").withColumnsRenamed({"a": "ha", "b": "hb"}), chains["conv_id"] == F.col("rep"))
    first = after.where(F.col("depth") == F.col("head") + 1).select(F.col("ha").alias("a"), F.col("hb").alias("b"), F.lit(1).alias("kids"), F.lit(1).alias("leaves"), F.col("saved_tokens").alias("saved"))
    tops = swept.where("a IS NOT NULL").select("a", "b", F.col("n_children").alias("kids"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")).unionByName(first)
    nodes = swept.where("a IS NULL").select(*_NODE).unionByName(chains.select(*_NODE)).unionByName(_heads(paths, tops))
    result = _NODE[:7]
    single = nodes.where("end_n IS NULL OR end_n = 1").select(*result, F.coalesce(F.sha2(F.col("end_rep").cast("string"), 256), F.lit(EMPTY_SHA256)).alias("ends_sha256"))
    several = nodes.where("end_n > 1").join(_digests(members), F.col("end_rep") == F.col("rep")).select(*result, "ends_sha256")
    return single.unionByName(several)
