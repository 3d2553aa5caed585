"""Exact removal of repeated byte strings by buckets of suffixes.

Suffixes are bucketed by their first 100 bytes, at sampled places: the smallest 16-byte-gram hash among every 301
consecutive starts. Any 400-byte string holds such a place with its 100 bytes inside, chosen from the string alone,
so equal strings share a bucket there. A suffix alone in its bucket is final. For the starts whose sampled suffix shares a
bucket, the hashes of their four 100-byte slices are paired to one of depth 400 within the task, and one more round
asks which of these occur elsewhere; no buckets of depth 200 are counted. Hashes have 64 bits and depend on the content
alone (the first round's also tell which whole texts are equal), so only the question "is it alone" needs a shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.exchange import Answers, Corpus
from tidemark.llm.rolling import Texts, U, fits, minimizers, mix

LENGTH = 400
GRAM = 100
SELECT = 16

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_starts array<long>, span_ends array<long>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("span_starts", pa.list_(pa.int64())), ("span_ends", pa.list_(pa.int64()))])


def _whole(texts: Texts) -> np.ndarray:
    data, o = texts.data.tobytes(), texts.offsets.tolist()
    digests = [hashlib.blake2b(data[a:b], digest_size=8).digest() for a, b in zip(o[:-1], o[1:])]
    return np.frombuffer(b"".join(digests), np.uint64)


def _sampled(texts: Texts) -> tuple:
    """Slices, starts of 400-byte strings, each start's sampled place, the distinct places and their buckets."""
    slices = texts.byte_slices()
    ok = fits(texts.offsets, LENGTH, len(texts.data))
    places = minimizers(slices.every(SELECT), LENGTH - GRAM + 1)[: len(ok)]
    starts = np.flatnonzero(ok)
    at = places[starts]
    distinct = np.unique(at)
    return slices, starts, at, distinct, slices.of(distinct, distinct + GRAM)


def _first_buckets(texts: Texts, answers: list[Answers]) -> np.ndarray:
    return np.concatenate([_whole(texts), _sampled(texts)[4]])


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U(3) + b * U(0x9E3779B97F4A7C15))


def _refined(texts: Texts, answers: list[Answers]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which texts have an equal; starts whose sampled suffix is not alone, in one of each set of equal texts; their
    buckets at depth 400."""
    slices, starts, at, distinct, buckets = _sampled(texts)
    shared, first = answers[0].about(np.concatenate([_whole(texts), buckets]))
    n = len(texts)
    twin, kept = shared[:n], np.repeat(first[:n], np.diff(texts.offsets))
    starts = starts[shared[n:][np.searchsorted(distinct, at)] & kept[starts]]
    depth = [slices.of(starts + k * GRAM, starts + (k + 1) * GRAM) for k in range(LENGTH // GRAM)]
    while len(depth) > 1:
        depth = [_pair(a, b) for a, b in zip(depth[::2], depth[1::2])]
    return twin, starts, depth[0]


def _deep_buckets(texts: Texts, answers: list[Answers]) -> np.ndarray:
    return _refined(texts, answers)[2]


def _finish(ids: list, texts: Texts, answers: list[Answers]) -> dict:
    twin, starts, buckets = _refined(texts, answers)
    repeated, _ = answers[1].about(buckets)
    n = len(texts.data)
    marks = np.zeros(n + 1, np.int32)
    np.add.at(marks, starts[repeated], 1)
    np.add.at(marks, starts[repeated] + LENGTH, -1)
    covered = np.cumsum(marks)[:n] > 0
    data, o = texts.data, texts.offsets.tolist()
    out = {f.name: [] for f in _ARROW}
    for k, doc in enumerate(ids):
        a, b = o[k], o[k + 1]
        gone = np.ones(b - a, bool) if twin[k] and b - a >= LENGTH else covered[a:b]
        edges = np.diff(np.r_[False, gone, False].astype(np.int8))
        out["doc_id"].append(doc)
        out["n_bytes"].append(b - a)
        out["n_removed"].append(int(gone.sum()))
        out["n_spans"].append(int((edges == 1).sum()))
        out["kept_sha256"].append(hashlib.sha256(data[a:b][~gone].tobytes()).hexdigest())
        out["span_starts"].append(np.flatnonzero(edges == 1))
        out["span_ends"].append(np.flatnonzero(edges == -1))
    return out


def repeated_bytes(df: DataFrame) -> DataFrame:
    """For each row of `df` (doc_id, text; others ignored): bytes covered by a 400-byte string that starts elsewhere too.

    Null texts are empty. Texts under 400 bytes lose nothing. Of equal texts of 400 bytes or more, all lose everything.
    A null or repeated doc_id is kept as it is, one result for each row. An empty table gives no rows. Spans are byte
    offsets, end exclusive.
    """
    corpus = Corpus(df)
    corpus.ask(_first_buckets)
    corpus.ask(_deep_buckets)
    return corpus.each(_finish, SCHEMA, _ARROW)
