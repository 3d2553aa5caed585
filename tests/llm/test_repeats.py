import random
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import de_bruijn, jaccard
from tidemark.llm.common import staged
from tidemark.llm.de_bruijn import repeated_words, unitigs
from tidemark.llm.exchange import Answers, _judged, _sent
from tidemark.llm.rolling import Slices, Texts
from tidemark.llm.suffix_buckets import repeated_bytes


def same(df, expected):
    got = sorted((tuple(r) for r in df.collect()), key=str)
    assert got == sorted(expected, key=str)


def test_bytes_match_brute_force(frame, odd_rows):
    same(repeated_bytes(frame(odd_rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), brute.byte_repeats(odd_rows))


def test_words_match_brute_force(frame, odd_rows):
    same(repeated_words(frame(odd_rows)).select("doc_id", "n_words", "n_removed", "kept_sha256"), brute.word_repeats(odd_rows))


def test_a_shared_passage_goes_from_400_bytes_on_however_many_words_it_has(frame):
    """Of 57 words each: the size of the text is the input's and tells nothing of what is removed."""
    rows = []
    for k, size in enumerate((399, 400)):
        passage = " ".join(f"w{k}{n:04}" for n in range(57)).ljust(size, "z")
        rows += [(10 * k + i, f"{end} before {i}{passage}{end} after {end}") for i, end in enumerate("ab")]
    found = {r.doc_id: r for r in repeated_bytes(frame(rows)).collect()}
    assert [(found[i].n_bytes, found[i].n_removed, found[i].n_spans) for i in (0, 1, 10, 11)] == [(418, 0, 0), (418, 0, 0), (419, 400, 1), (419, 400, 1)]
    same(repeated_bytes(frame(rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), brute.byte_repeats(rows))


def test_empty_tables(frame):
    assert repeated_bytes(frame([])).collect() == []
    spans = repeated_words(frame([]))
    assert spans.collect() == [] and unitigs(spans).collect() == []


def test_unitigs_hold_each_repeated_edge_once(frame, odd_rows):
    spans = repeated_words(frame(odd_rows))
    docs = [brute.WORD.findall((t or "").encode()) for _, t in odd_rows]
    edges = {e for e, n in brute._windows(docs, 35).items() if n > 1}
    found = unitigs(spans)
    assert found.agg(F.sum("edges")).first()[0] == len(edges)
    out, into = {}, {}
    for e in edges:
        out.setdefault(e[:-1], []).append(e)
        into.setdefault(e[1:], []).append(e)
    group = {e: e for e in edges}

    def root(e):
        while group[e] != e:
            e = group[e]
        return e

    for node, before in into.items():
        if len(before) == 1 and len(out.get(node, [])) == 1:
            group[root(before[0])] = root(out[node][0])
    assert found.select("unitig").distinct().count() == len({root(e) for e in edges})


def rounds_by_hand(rows, size, steps, finish):
    """The rounds of the exchange over blocks of `size` texts, in this process."""
    blocks = []
    for k in range(0, len(rows), size):
        texts = [(t or "").encode() for _, t in rows[k : k + size]]
        blocks.append(([i for i, _ in rows[k : k + size]], Texts(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))))
    answers = [[] for _ in blocks]
    for step in steps:
        buckets, replies = defaultdict(list), defaultdict(list)
        for k, (_, texts) in enumerate(blocks):
            for bucket, items, n in _sent(step(texts, answers[k]), 4):
                buckets[bucket].append(dict(block=k, bucket=bucket, n=n, items=items))
        for sent in buckets.values():
            for reply in _judged(pa.Table.from_pylist(sent)).to_pylist():
                replies[reply["block"]].append(reply)
        for k in range(len(blocks)):
            answers[k].append(Answers(replies[k]))
    made = [finish(ids, texts, answers[k]) for k, (ids, texts) in enumerate(blocks)]
    return [row for m in made for row in zip(m["doc_id"], m["n_words"], m["n_removed"], m["kept_sha256"])]


def test_paths_are_verified_by_their_words(odd_rows, monkeypatch):
    """With edges of eight bits nearly all count as repeated; their words decide."""
    of = Slices.of

    def weak(self, start, end):
        hashes = of(self, start, end)
        return hashes & np.uint64(255) if len(start) and (end - start == de_bruijn.WINDOW).all() else hashes

    steps = [de_bruijn._grams, lambda texts, answers: de_bruijn._edges(texts, answers)[1], de_bruijn._nodes, de_bruijn._digests]
    expected = sorted(brute.word_repeats(odd_rows), key=str)
    for size in (1, 7, len(odd_rows)):
        assert sorted(rounds_by_hand(odd_rows, size, steps, de_bruijn._finish), key=str) == expected
    monkeypatch.setattr(Slices, "of", weak)
    assert sorted(rounds_by_hand(odd_rows, 7, steps, de_bruijn._finish), key=str) == expected


def test_a_path_lies_whole_in_each_place(frame, odd_rows):
    """No place of a path's first edge is without the rest of the path."""
    docs = {i: brute.WORD.findall((t or "").encode()) for i, t in odd_rows if i is not None}
    sets = [brute.WORD.findall((t or "").encode()) for _, t in odd_rows]
    for row in repeated_words(frame([r for r in odd_rows if r[0] not in (407, 3)])).collect():
        for path in row.paths:
            if row.doc_id is None:
                continue
            words = docs[row.doc_id][path.start : path.start + path.edges + 34]
            for other in sets:
                for p in range(len(other) - 34):
                    if other[p : p + 35] == words[:35]:
                        assert other[p : p + len(words)] == words


def test_near_copies_make_one_list_for_all_tokens_that_they_share(frame, monkeypatch):
    rng = random.Random(11)
    texts = [[f"t{k}w{rng.randrange(10**6)}" for _ in range(200)] for k in range(12)]
    rows = [(2 * k, " ".join(t)) for k, t in enumerate(texts)] + [(2 * k + 1, " ".join([*t[:100], "changed", *t[101:]])) for k, t in enumerate(texts)]
    made = {}

    def recorded(df, name):
        out = staged(df, name)
        made.setdefault(name, (out.columns, out.count()))
        return out

    monkeypatch.setattr(jaccard, "staged", recorded)
    found = {r.doc_id: r.component_id for r in jaccard.similar_documents(frame(rows)).collect()}
    assert found == {i: i - i % 2 for i in range(24)}
    # a list of two rows for each pair, not for each of some forty tokens of their prefixes
    assert made["lists"][1] == 24
    assert not {"tokens", "sketch", "long_sketch"} & set(made["prefixes"][0])
