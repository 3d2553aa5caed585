import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, block int, bucket int, n int, replies int"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names clash with the operators' own."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, 3, 4) for i, t in rows], DOCS)

    return make


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}{'é' if rng.random() < 0.05 else ''}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Copies, near copies, shared passages, repeats inside a text, nulls, empties, blanks, a long text, tied and repeated rows."""
    rng = random.Random(5)
    base = [words(rng, rng.choice([3, 30, 80, 200])) for _ in range(25)]
    passage, line = words(rng, 90), words(rng, 60)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + k, base[k % 3 + 5]) for k in range(9)]
    for k in range(10):
        w = base[10 + k % 4].split(" ")
        w[rng.randrange(len(w))] = "changed"
        rows.append((200 + k, " ".join(w)))
    rows += [(300 + k, words(rng, 20 + k) + "\n" + passage[: 500 - 7 * k] + " " + words(rng, 11)) for k in range(8)]
    rows += [(400, line + " " + line + " " + line), (401, "ab " * 300), (402, None), (403, ""), (404, " \t\n"), (405, "word"), (406, "x" * 900)]
    rows += [(407, words(rng, 6000)), (407, words(rng, 50)), (3, base[3]), (None, passage), (408, "Word"), (409, None)]
    return rows
