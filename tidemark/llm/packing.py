"""Packing of token sequences by a configuration linear program over the histogram of lengths.

A configuration is a set of pieces that fits one sequence. The program "cover every length's count with as few
configurations as possible" is solved by multiplicative weights: a knapsack dynamic program finds the most valuable
configuration around each length under the current weights, and lengths that are covered too often lose weight.
The solution is rounded down, best fit places the rest, and Spark deals the pieces to the configurations' places.
Lengths are at most the capacity, so everything on the driver is bounded by the capacity and not by the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import arrow_rows, giving_back, own_columns, staged, text_or_empty
from tidemark.llm.numbering import numbered

CAPACITY = 2048
ROUNDS = 40
END_ID = 0
#: Both tokenizer libraries split such texts alike: no characters whose class differs between Unicode versions, and
#: no very long runs, on which the faster one takes quadratic time.
_PLAIN = re.compile("[\\x20-\\x7e\\n\\t\\r¡-ɏ]*")
_RUN = re.compile(r"\S{1500}|\s{1500}")
_loaded: dict[str, object] = {}


def _encoder(json_path: str | None, ranks_path: str | None):
    """Text to ids by the tokenizer file; plain texts by the same vocabulary's ranks, several times faster."""
    import public_tokenizers

    json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if json_path not in _loaded:
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(json_path)
        slow.encode_special_tokens = True
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> np.ndarray:
            if _PLAIN.fullmatch(text) and not _RUN.search(text):
                return np.array(fast.encode_ordinary(text), "<u4")
            return np.array(slow.encode(text, add_special_tokens=False).ids, "<u4")

        _loaded[json_path] = encode
    return _loaded[json_path]


def pieces(df: DataFrame, capacity: int = CAPACITY, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """Of each row of `df` (doc_id, text): row, doc_id, piece, start, length, ids_crc32; staged."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(json_path, ranks_path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encode(text), np.array([END_ID], "<u4"))
                at = 0
                first = len(ids) % capacity or min(len(ids), capacity)
                for k in range(-(-len(ids) // capacity)):
                    part = ids[at : at + (first if k == 0 else capacity)]
                    rows.append((doc, k, at, len(part), zlib.crc32(part.tobytes())))
                    at += len(part)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    source = own_columns(df, "doc_id", "text").select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    with arrow_rows(df.sparkSession):
        return staged(source.mapInArrow(giving_back(cut), schema).withColumn("row", F.monotonically_increasing_id()), "pieces")


def _priced(lengths: np.ndarray, weight: np.ndarray, capacity: int) -> np.ndarray:
    """For each room up to the capacity, the index of the length to take first for the most weight; -1: leave one place empty."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    for room in range(1, capacity + 1):
        k = np.searchsorted(lengths, room, side="right")
        best[room] = best[room - 1]
        if k:
            values = best[room - lengths[:k]] + weight[:k]
            i = int(values.argmax())
            if values[i] > best[room]:
                best[room], take[room] = values[i], i
    return take


def _around(lengths: np.ndarray, take: np.ndarray, capacity: int) -> list[tuple]:
    """For each length, the best configuration that holds it, as a sorted tuple of indexes."""
    out = []
    for i, n in enumerate(lengths.tolist()):
        room, chosen = capacity - n, [i]
        while room > 0:
            j = take[room]
            if j < 0:
                room -= 1
            else:
                chosen.append(int(j))
                room -= int(lengths[j])
        out.append(tuple(sorted(chosen)))
    return out


def _fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int) -> Counter:
    """Configurations and how often to use each, by multiplicative weights."""
    weight, use = lengths / capacity, Counter()
    for _ in range(rounds):
        chosen = _around(lengths, _priced(lengths, weight, capacity), capacity)
        covered = np.zeros(len(lengths))
        for i, c in enumerate(chosen):
            share = counts[i] / c.count(i) / rounds
            use[c] += share
            np.add.at(covered, list(c), share * rounds)
        over = covered / counts
        weight = weight * np.exp(-0.15 * np.clip(over / over.mean() - 1, -1, 3))
        weight = np.maximum(weight * (lengths / capacity).sum() / weight.sum(), 1e-9)
    return use


def _rounded(use: Counter, lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Whole numbers of configurations that use each length exactly as often as it comes."""
    left, out = counts.copy(), []
    fill = {c: int(lengths[list(c)].sum()) for c in use}
    for c in sorted(use, key=lambda c: (-fill[c], -use[c], c)):
        # nearly full ones only; the rest is best placed piece by piece
        if fill[c] < 0.98 * capacity:
            break
        need = Counter(c)
        n = min(int(use[c]), min(int(left[i]) // k for i, k in need.items()))
        if n:
            out.append((c, n))
            for i, k in need.items():
                left[i] -= n * k
    open_bins: dict[int, Counter] = {}
    for i in range(len(lengths) - 1, -1, -1):
        n, size = int(left[i]), int(lengths[i])
        while n:
            room = min((r for r, bins in open_bins.items() if r >= size and bins), default=None)
            if room is None:
                fit = capacity // size
                whole, part = divmod(n, fit)
                for k, m in ((fit, whole), (part, 1)):
                    if k and m:
                        open_bins.setdefault(capacity - k * size, Counter())[(i,) * k] += m
                break
            c, m = open_bins[room].popitem()
            moved = min(m, n)
            if m > moved:
                open_bins[room][c] = m - moved
            open_bins.setdefault(room - size, Counter())[(*c, i)] += moved
            n -= moved
    return out + [(tuple(sorted(c)), m) for bins in open_bins.values() for c, m in bins.items()]


def configurations(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """[({length: pieces of it in the sequence}, sequences)], which together hold exactly the histogram."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    use = _fractional(lengths, counts, capacity, rounds)
    return [({int(lengths[i]): k for i, k in Counter(c).items()}, n) for c, n in _rounded(use, lengths, counts, capacity)]


def _places(plan: list[tuple[dict[int, int], int]]) -> pa.Table:
    """For each length, which of its pieces, by number, go to which sequences at which place."""
    taken, rows, sequence = Counter(), [], 0
    for parts, n in plan:
        offset = 0
        for length, k in sorted(parts.items(), reverse=True):
            rows.append((length, taken[length], taken[length] + n * k, sequence, k, offset))
            taken[length] += n * k
            offset += length * k
        sequence += n
    names = ["length", "low", "high", "first_sequence", "per", "first_offset"]
    return pa.table({c: pa.array([r[i] for r in rows], pa.int64()) for i, c in enumerate(names)})


def pack(df: DataFrame, capacity: int = CAPACITY, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """The pieces of all rows of `df` (doc_id, text; others ignored) in sequences of at most `capacity` tokens: doc_id,
    piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty and is one piece, the end id. Only documents longer than the capacity are cut, into pieces of
    the capacity after a first one that may be shorter. Rows with a null or repeated doc_id are documents like others. An empty
    table gives no rows.
    """
    cut = pieces(df, capacity, json_path, ranks_path)
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(configurations(histogram, capacity))
    spark = df.sparkSession
    ranges = spark.createDataFrame(places) if places.num_rows else spark.createDataFrame([], "length long, low long, high long, first_sequence long, per long, first_offset long")
    dealt = numbered(cut, "length", "row", "turn", sum(histogram.values()))
    ranges = ranges.withColumnRenamed("length", "range_length")
    here = (F.col("length") == F.col("range_length")) & (F.col("turn") >= F.col("low")) & (F.col("turn") < F.col("high"))
    k = F.col("turn") - F.col("low")
    # no more ranges than configurations times their lengths, whatever the corpus
    return dealt.join(F.broadcast(ranges), here).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(k / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + F.pmod(k, F.col("per")) * F.col("length")).cast("long").alias("offset"))
