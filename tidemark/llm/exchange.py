"""Which of very many 64-bit hashes occur more than once in a corpus, at nearly eight bytes a hash.

Documents are packed into blocks of about two megabytes. A round sends each block's distinct hashes to buckets by
hash range, packed into one binary row for each block and bucket; the bucket answers with two bits a hash: "it occurs
elsewhere or twice here" and "this block is the first that has it". Where a step sends contexts with its hashes, the first
bit says "it occurs with two contexts" instead. A hash that every document has is sent once a block, so no bucket is hot. Blocks are staged in the shared folder and each round's answers too; whatever is lost is
computed again from there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import arrow_rows, give_back, giving_back, own_columns, released, staged, text_or_empty
from tidemark.llm.rolling import Texts

BLOCK_BYTES = 2_000_000
BLOCK_ROWS = 4
#: Bytes of hashes that one bucket may hold in memory, if every byte of the corpus sent one.
BUCKET_BYTES = 48_000_000

#: A step gets the texts and the answers of all earlier rounds and gives the hashes to send, or hashes and a 32-bit
#: context for each.
Step = Callable[[Texts, list["Answers"]], np.ndarray | tuple[np.ndarray, np.ndarray]]


def pack(df: DataFrame) -> DataFrame:
    """Blocks of whole documents: block, doc_ids, sizes, and the texts as one zstd frame. Null texts are empty."""
    codec = "zstd"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and size + len(t) > BLOCK_BYTES:
                    yield row(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if ids:
            yield row(ids, texts)

    def row(ids, texts):
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([pa.compress(b"".join(texts), codec, asbytes=True)], pa.binary())], ["doc_ids", "sizes", "data"])

    rows = own_columns(df, "doc_id", "text").select(F.col("doc_id").cast("long"), text_or_empty().cast("binary").alias("text"))
    blocks = rows.mapInArrow(giving_back(packed), "doc_ids array<long>, sizes array<long>, data binary")
    with arrow_rows(df.sparkSession):
        return staged(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


class Answers:
    """What a round said about the hashes that this block sent."""

    def __init__(self, replies: list[dict]):
        parts = [np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=2 * r["n"]) for r in sorted(replies, key=lambda r: r["bucket"])]
        flags = np.concatenate(parts).reshape(-1, 2).astype(bool) if parts else np.zeros((0, 2), bool)
        self.repeated, self.first = flags[:, 0], flags[:, 1]

    def about(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each hash sent, in order: it is repeated (or has two contexts); this is its first place in the corpus."""
        if not len(items):
            return np.zeros(0, bool), np.zeros(0, bool)
        _, place, inverse = np.unique(items, return_index=True, return_inverse=True)
        here = np.zeros(len(items), bool)
        here[place] = True
        return self.repeated[inverse], self.first[inverse] & here


def _bucket(sorted_items: np.ndarray, buckets: int) -> np.ndarray:
    return ((sorted_items >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _sent(made: np.ndarray | tuple[np.ndarray, np.ndarray], buckets: int) -> Iterator[tuple[int, bytes, int]]:
    items, contexts = made if isinstance(made, tuple) else (made, None)
    distinct, place, inverse, counts = np.unique(items, return_index=True, return_inverse=True, return_counts=True)
    many, kept = counts > 1, None
    if contexts is not None:
        kept = contexts[place].astype(np.uint32)
        many = np.zeros(len(distinct), bool)
        many[inverse[contexts != kept[inverse]]] = True
    at = _bucket(distinct, buckets)
    edges = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True]) if len(at) else []
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(at[a]), distinct[a:b].tobytes() + np.packbits(many[a:b]).tobytes() + (b"" if kept is None else kept[a:b].tobytes()), int(b - a)


def _judged(group: pa.Table) -> pa.Table:
    """One bucket: the flags for each block that sent something to it."""
    blocks, counts = group.column("block").to_numpy(), group.column("n").to_numpy()
    parts, many, contexts = [], [], []
    for payload, n in zip(group.column("items").to_pylist(), counts.tolist()):
        bits = 8 * n + -(-n // 8)
        parts.append(np.frombuffer(payload, np.uint64, count=n))
        many.append(np.unpackbits(np.frombuffer(payload, np.uint8, offset=8 * n, count=bits - 8 * n), count=n))
        if len(payload) > bits:
            contexts.append(np.frombuffer(payload[bits:], np.uint32))
    items, twice, owner = np.concatenate(parts), np.concatenate(many).astype(bool), np.repeat(blocks, counts)
    order = np.lexsort((owner, items))
    ranked = items[order]
    first = np.r_[True, ranked[1:] != ranked[:-1]]
    group_no = np.cumsum(first) - 1
    begins = np.flatnonzero(first)
    repeated = np.logical_or.reduceat(twice[order], begins)
    if contexts:
        context = np.concatenate(contexts)[order]
        repeated |= np.minimum.reduceat(context, begins) != np.maximum.reduceat(context, begins)
    else:
        repeated |= np.bincount(group_no) > 1
    flags = np.empty((len(items), 2), np.uint8)
    flags[order, 0], flags[order, 1] = repeated[group_no], first
    ends = np.cumsum(counts)
    return pa.table({
        "block": pa.array(blocks, pa.int64()),
        "bucket": pa.array(group.column("bucket").to_numpy(), pa.int32()),
        "n": pa.array(counts, pa.int32()),
        "flags": pa.array([np.packbits(flags[e - n : e]).tobytes() for e, n in zip(ends.tolist(), counts.tolist())], pa.binary()),
    })


def _texts(row: dict) -> Texts:
    offsets = np.r_[0, np.cumsum(row["sizes"], dtype=np.int64)]
    data = pa.decompress(row["data"], decompressed_size=int(offsets[-1]), codec="zstd", asbytes=True)
    return Texts(np.frombuffer(data, np.uint8), offsets)


def _joined(blocks: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """One shuffle of the blocks for all rounds; the answers grow with the corpus, so they are never broadcast."""
    out = blocks
    for k, answers in enumerate(rounds):
        out = out.join(answers.withColumnRenamed("replies", f"replies{k}").hint("shuffle_hash"), "block", "left")
    return out


def _rows(batches: Iterator[pa.RecordBatch], n_rounds: int) -> Iterator[tuple[dict, Texts, list[Answers]]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row, _texts(row), [Answers(row[f"replies{k}"] or []) for k in range(n_rounds)]
    give_back()


class Corpus:
    """Blocks of a corpus and the answers of the rounds held so far."""

    def __init__(self, df: DataFrame):
        self.blocks = pack(df)
        size = F.expr("aggregate(sizes, 0L, (a, n) -> a + n)")
        total = self.blocks.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
        self.buckets = max(16, -(-8 * total // BUCKET_BYTES))
        self.rounds: list[DataFrame] = []
        self.answers: list[DataFrame] = []

    def ask(self, step: Step) -> None:
        """One round: all hashes that `step` gives are judged."""
        buckets, before = self.buckets, len(self.rounds)

        def send(batches):
            for row, texts, answers in _rows(batches, before):
                out = list(_sent(step(texts, answers), buckets))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(out), pa.int64()), pa.array([x[0] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())],
                    ["block", "bucket", "n", "items"])

        sent = _joined(self.blocks, self.rounds).mapInArrow(send, "block long, bucket int, n int, items binary")
        judged = sent.groupBy("bucket").applyInArrow(_judged, "block long, bucket int, n int, flags binary")
        with arrow_rows(self.blocks.sparkSession, BLOCK_ROWS):
            kept = staged(judged, "answers")
        self.answers.append(kept)
        self.rounds.append(kept.groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "flags")).alias("replies")))

    def each(self, finish: Callable[[list, Texts, list[Answers]], dict], schema: str, arrow: pa.Schema) -> DataFrame:
        """Rows that `finish` makes of each block's ids, texts and answers, with `row`, a number of their own; staged."""
        rounds = len(self.rounds)

        def run(batches):
            for row, texts, answers in _rows(batches, rounds):
                made = finish(row["doc_ids"], texts, answers)
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

        with arrow_rows(self.blocks.sparkSession, BLOCK_ROWS):
            return staged(_joined(self.blocks, self.rounds).mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "found")

    def release(self) -> None:
        """Deletes the blocks and answers; what each() gave is staged and stays."""
        released(self.blocks, *self.answers)
