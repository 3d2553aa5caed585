"""Removal of repeated word runs through a compacted De Bruijn graph of the repeated 35-word edges.

An edge is a run of 35 words, its ends are nodes, runs of 34. Edges that can repeat are found by nine-word minimizers
(any 35-word run holds one, chosen from the run alone), and a second round tells which edges occur twice. Consecutive
repeated edges of a document are a walk through the graph. A third round sends the nodes of all walks with the words
before and after; a node with two such contexts branches, and the ends of walks count as contexts of their own. Walks are
cut at branching nodes into paths. As walks' ends branch too, a path lies whole wherever one of its edges does, so a path
is compared as one: its words are read at its source coordinates, and a fourth round tells which paths' words, by a digest
that does not depend on the edges' hashes, start elsewhere too. These paths' coordinates are the spans to remove.

unitigs() joins paths further: where only the end of a walk cut them, a node has one path in and one out, and Spark joins
hook the two together; pointer doubling gives each chain one id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import own_columns, small, staged
from tidemark.llm.exchange import Answers, Corpus
from tidemark.llm.rolling import Slices, Texts, U, fits, minimizers

WINDOW = 35
GRAM = 9
#: Contexts of nodes where a walk begins or ends; others are hashes of the node with the words beside it.
WALK_BEGINS, WALK_ENDS = 0, 1

SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, span_starts array<long>, span_ends array<long>, paths array<struct<head:long,tail:long,first_edge:long,edges:long,start:long>>"
_PATH = pa.list_(pa.struct([("head", pa.int64()), ("tail", pa.int64()), ("first_edge", pa.int64()), ("edges", pa.int64()), ("start", pa.int64())]))
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("span_starts", pa.list_(pa.int64())), ("span_ends", pa.list_(pa.int64())), ("paths", _PATH)])


def _sampled(texts: Texts) -> tuple:
    words, start, end, begins = texts.words()
    slices = Slices(words)
    ok = fits(begins, WINDOW, len(words))
    grams = slices.every(GRAM)
    places = minimizers(grams, WINDOW - GRAM + 1)[: len(ok)]
    starts = np.flatnonzero(ok)
    at = places[starts]
    distinct = np.unique(at)
    return slices, starts, at, distinct, grams[distinct], (start, end, begins)


def _grams(texts: Texts, answers: list[Answers]) -> np.ndarray:
    return _sampled(texts)[4]


def _edges(texts: Texts, answers: list[Answers]) -> tuple:
    slices, starts, at, distinct, grams, where = _sampled(texts)
    shared, _ = answers[0].about(grams)
    starts = starts[shared[np.searchsorted(distinct, at)]] if len(starts) else starts
    return starts, slices.of(starts, starts + WINDOW), slices, where


def _walks(texts: Texts, answers: list[Answers]) -> tuple:
    """Starts of the repeated edges, whether a walk begins or ends there, hashes of slices and where words lie."""
    starts, edges, slices, where = _edges(texts, answers)
    own = starts[answers[1].about(edges)[0]]
    fresh = np.ones(len(own), bool)
    fresh[1:] = own[1:] != own[:-1] + 1  # a text's last edge and the next one's first are never neighbours
    return own, fresh, np.r_[fresh[1:], True][: len(own)], slices, where


def _nodes(texts: Texts, answers: list[Answers]) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the walks: first the one before each edge, then each walk's last; and their contexts."""
    own, fresh, lasts, slices, _ = _walks(texts, answers)
    nodes = np.concatenate([own, own[lasts] + 1])
    contexts = np.full(len(nodes), WALK_ENDS, np.uint32)
    contexts[: len(own)] = WALK_BEGINS
    inner = own[~fresh]
    contexts[: len(own)][~fresh] = slices.of(inner - 1, inner + WINDOW).astype(np.uint32)
    return slices.of(nodes, nodes + WINDOW - 1), contexts


def _paths(texts: Texts, answers: list[Answers]) -> tuple:
    """First and last node of each path, a digest of its words, hashes of slices and where words lie."""
    own, fresh, lasts, slices, where = _walks(texts, answers)
    branching, _ = answers[2].about(_nodes(texts, answers)[0])
    cut = fresh | branching[: len(own)]
    heads, tails = own[cut], own[np.r_[cut[1:], True][: len(own)]] + 1
    data, (start, end, _) = texts.data.tobytes(), where
    digests = np.zeros(len(heads), U)
    for k, (a, b) in enumerate(zip(heads.tolist(), (tails + WINDOW - 1).tolist())):
        words = b" ".join([data[i:j] for i, j in zip(start[a:b].tolist(), end[a:b].tolist())])
        digests[k] = int.from_bytes(hashlib.blake2b(words, digest_size=8).digest(), "little")
    return heads, tails, digests, slices, where


def _digests(texts: Texts, answers: list[Answers]) -> np.ndarray:
    return _paths(texts, answers)[2]


def _finish(ids: list, texts: Texts, answers: list[Answers]) -> dict:
    heads, tails, digests, slices, (word_start, word_end, begins) = _paths(texts, answers)
    verified, first = answers[3].about(digests)
    total = int(begins[-1])
    marks = np.zeros(total + 1, np.int32)
    np.add.at(marks, heads[verified], 1)
    np.add.at(marks, tails[verified] + WINDOW - 1, -1)
    covered = np.cumsum(marks)[:total] > 0
    heads, tails = heads[verified & first], tails[verified & first]
    ends = slices.of(heads, heads + WINDOW - 1).view(np.int64), slices.of(tails, tails + WINDOW - 1).view(np.int64)
    firsts = slices.of(heads, heads + WINDOW).view(np.int64)
    data, b = texts.data.tobytes(), begins.tolist()
    out = {f.name: [] for f in _ARROW}
    for k, doc in enumerate(ids):
        i, j = b[k], b[k + 1]
        gone = covered[i:j]
        change = np.diff(np.r_[False, gone, False].astype(np.int8))
        kept = np.flatnonzero(~gone) + i
        digest = hashlib.sha256(b" ".join([data[s:e] for s, e in zip(word_start[kept].tolist(), word_end[kept].tolist())]))
        here = slice(*np.searchsorted(heads, [i, j]))
        out["doc_id"].append(doc)
        out["n_words"].append(j - i)
        out["n_removed"].append(int(gone.sum()))
        out["kept_sha256"].append(digest.hexdigest())
        out["span_starts"].append(np.flatnonzero(change == 1))
        out["span_ends"].append(np.flatnonzero(change == -1))
        out["paths"].append([
            dict(head=h, tail=t, first_edge=e, edges=n, start=s)
            for h, t, e, n, s in zip(ends[0][here].tolist(), ends[1][here].tolist(), firsts[here].tolist(), (tails - heads)[here].tolist(), (heads[here] - i).tolist())])
    return out


def repeated_words(df: DataFrame) -> DataFrame:
    """For each row of `df` (doc_id, text; others ignored): words covered by a 35-word run that starts elsewhere too.

    Null texts have no words. Documents under 35 words lose nothing. A null or repeated doc_id is kept, one result for
    each row; an empty table gives none. `paths` are the unbranched paths of the graph that lie here first; word
    offsets, end exclusive.

    Edges, nodes and paths are equal by 64-bit hashes; a span is removed only if a second 64-bit digest of its path's
    words agrees with that of another place.
    """
    corpus = Corpus(df)
    corpus.ask(_grams)
    corpus.ask(lambda texts, answers: _edges(texts, answers)[1])
    corpus.ask(_nodes)
    corpus.ask(_digests)
    return corpus.each(_finish, SCHEMA, _ARROW)


def unitigs(spans: DataFrame) -> DataFrame:
    """The maximal unbranched chains of the paths in repeated_words(): unitig, first_edge, doc_id, start, edges.

    A row for each path; the paths of a chain share `unitig`, the first edge of the chain's first path, or on a ring
    the smallest one. Two paths are hooked where a node has exactly one path in and one out. Pointer doubling takes as
    many joins as the logarithm of the longest chain.
    """
    paths = staged(own_columns(spans, "doc_id", "paths").select("doc_id", F.inline("paths")), "paths")
    none = F.lit(None).cast("long")
    ends = paths.select(F.col("tail").alias("node"), F.col("first_edge").alias("into"), none.alias("out")).unionAll(
        paths.select(F.col("head").alias("node"), none.alias("into"), F.col("first_edge").alias("out")))
    met = ends.groupBy("node").agg(F.count("into").alias("n_in"), F.count("out").alias("n_out"), F.max("into").alias("back"), F.max("out").alias("path"))
    chain = staged(met.where("n_in = 1 AND n_out = 1").select("path", "back", F.least("path", "back").alias("least"), F.lit(True).alias("ring")), "chain")
    for _ in range(chain.count().bit_length() + 1):
        step = chain.select(F.col("path").alias("back"), F.col("back").alias("further"), F.col("least").alias("beyond"))
        # a pointer that still moves after so many doublings is on a ring, and has met all of it
        chain = staged(chain.drop("ring").join(small(step, computed=True), "back", "left").select(
            "path", F.coalesce("further", "back").alias("back"), F.least("least", "beyond").alias("least"), F.col("further").isNotNull().alias("ring")), "chain")
        if chain.where("ring").isEmpty():
            break
    named = chain.select(F.col("path").alias("first_edge"), F.when(F.col("ring"), F.col("least")).otherwise(F.col("back")).alias("chained"))
    return paths.join(named, "first_edge", "left").select(F.coalesce("chained", "first_edge").alias("unitig"), "first_edge", "doc_id", "start", "edges")
