"""Clustering, the prefix trie and the secret scan against plain re-statements and their SQL."""

import hashlib
import random

import numpy as np
import pytest
import secrets_brute
import trie_brute
from compare import connect, differences

from tidemark.llm import prefix_trie as trie_module, secrets
from tidemark.llm.pivots import choose_pivots, cluster_vectors, nearest
from tidemark.llm.prefix_trie import prefix_trie
from tidemark.llm.queries import QUERIES, SQL
from tidemark.llm.secrets import secret_spans


@pytest.mark.parametrize("name", ["op11_pivot_clusters", "op12_prefix_trie"])
def test_queries_match_sql(name, spark):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES[name](spark, folder), connect(folder), SQL[name]) is None


# ---- clustering

VECTORS = "vec_id long, embedding array<float>, label int, cluster int, vector int, place int"


def plain_clusters(rows, k=16, rounds=3):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and abs(x) < float("inf") for x in v):
            kept.append((i, [int(np.floor(64.0 * float(np.float32(x)))) for x in v], [float(np.float32(x)) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2]))
    centroids = [list(r[1]) for r in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v, _ in kept]

    for _ in range(rounds):
        labels = [j for _, j in assign()]
        for j in range(len(centroids)):
            mine = [kept[n][1] for n, x in enumerate(labels) if x == j]
            if mine:
                centroids[j] = [sum(col) // len(mine) for col in zip(*mine)]
    found = assign()
    total = {j: sum(d for d, x in found if x == j) for j in range(len(centroids))}
    big = 1 << 63
    return [
        (r[0], j, d if d < big else None, total[j] if total[j] < big and all(d < big for d, x in found if x == j) else None,
         sum(total.values()) if sum(total.values()) < big and all(d < big for d, _ in found) else None, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
        for r, (d, j) in zip(kept, found)]


def odd_vectors(rng, scale=1.0, n=60):
    rows = [(i, [rng.gauss(0, scale) for _ in range(64)]) for i in range(n)]
    rows += [(100 + i, list(rows[3][1])) for i in range(20)] + [(7, list(rows[7][1])), (7, list(rows[8][1])), (None, list(rows[9][1])), (None, None)]
    rows += [(200, [0.5] * 63), (201, [0.5] * 65), (202, [0.5] * 63 + [None]), (203, [float("nan")] + [0.0] * 63), (204, [0.0] * 63 + [float("-inf")]), (205, []), (206, None)]
    return rows + [(300 + i, [float(i % 2)] * 64) for i in range(6)]


@pytest.mark.parametrize("scale", [1.0, 1e7, 1e30])
def test_clusters_match_brute_force(spark, scale):
    rows = odd_vectors(random.Random(4), scale)
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS)
    got = sorted((tuple(r)[:6] for r in cluster_vectors(df).collect()), key=str)
    assert got == sorted(plain_clusters(rows), key=str)


def test_few_and_no_vectors(spark):
    for rows in ([], [(1, None)], [(1, [1.0] * 64)], [(i, [float(i)] * 64) for i in range(5)], [(1, [2.0] * 64)] * 30):
        df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS)
        assert sorted((tuple(r)[:6] for r in cluster_vectors(df).collect()), key=str) == sorted(plain_clusters(rows), key=str)


def test_pivots_rule_out_centroids_and_lose_none():
    rng = np.random.default_rng(2)
    middles = rng.integers(-3000, 3000, (16, 64))
    vectors = np.repeat(middles, 50, axis=0) + rng.integers(-40, 40, (800, 64))
    pivots = choose_pivots(vectors[::50].astype(float), 8)
    to_pivots = np.sqrt(((vectors[:, None] - pivots[None]) ** 2).sum(axis=2))
    label, best, n_exact = nearest(vectors.astype(float), to_pivots, middles.tolist(), pivots)
    every = ((vectors[:, None] - middles[None]) ** 2).sum(axis=2)
    assert (label == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert n_exact.mean() < 3 and len({tuple(p) for p in pivots}) == 8


# ---- prefix trie

TURNS = "conv_id long, turn long, role string, text string, rep int, depth int, a string, n int"


def conversations(rng, n, long=0):
    """Families with shared starts, copies, missing bases, empty conversations after rebuilding, nulls and very long ones."""
    openings = [[("user", f"opening {i} " + "w " * rng.randrange(4)) for i in range(rng.randrange(1, 9))] for _ in range(4)]
    rows = []
    for c in rng.sample(range(-30, 4 * n), n):
        turns = list(rng.choice(openings)[: rng.randrange(0, 9)]) + [(rng.choice(["user", "bot", None]), rng.choice(["yes", "no", "", None, "a b\tc"])) for _ in range(rng.randrange(0, 4))]
        rows += [(c, None if rng.random() < 0.05 and k == 0 else k, *t) for k, t in enumerate(turns or [("user", "only")])]
    for c in range(10 * n, 10 * n + long):
        rows += [(c, k, "user", f"t{k} x y") for k in range(120 + c % 2 * 40)]
    return rows


def tie_key(spark, rows):
    """The order of turns with the same number: by turn id."""
    pairs = sorted({(r[2] or "", r[3] or "") for r in rows})
    df = spark.createDataFrame(pairs, "r string, t string").selectExpr("r", "t", "xxhash64(r, t) AS a")
    ids = {(x.r, x.t): x.a for x in df.collect()}
    return ids.__getitem__


@pytest.mark.parametrize("limit", [8192, 30, 2])
def test_trie_matches_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(trie_module, "CONTAINER_TURNS", limit)
    monkeypatch.setattr(trie_module, "CHUNK", 3)
    for seed in (1, 2):
        rng = random.Random(seed)
        rows = conversations(rng, 60, long=5)
        rows += [(None, 0, "user", "x"), (None, None, None, None), *rows[:5], (3, 0, "user", "tie"), (3, 0, "bot", "tie"), (3, None, "z", None)]
        df = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], TURNS).repartition(5)
        got = sorted((tuple(r) for r in prefix_trie(df).collect()), key=str)
        assert got == sorted(trie_brute.trie(rows, tie_key(spark, rows)), key=str)


def test_long_copies_of_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie_module, "CONTAINER_TURNS", 40)
    rows = [(c, k, "user", f"turn {k}") for c in (0, 20, 40, 60, 80) for k in range(300)]
    got = sorted((tuple(r) for r in prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=str)
    assert got == sorted(trie_brute.trie(rows), key=str)


def test_small_tables_of_conversations(spark):
    for rows in ([], [(None, 1, "a", "b")], [(1, None, None, None)], [(21, 0, "u", "t")], [(k, 0, "u", "same") for k in range(9)]):
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        assert sorted((tuple(r) for r in prefix_trie(df).collect()), key=str) == sorted(trie_brute.trie(rows), key=str)


# ---- secrets

LOWER, UPPER, DIGITS = secrets_brute.LOWER, secrets_brute.UPPER, secrets_brute.DIGITS


def token(rng, n, alphabet):
    return "".join(rng.choice(alphabet) for _ in range(n))


def secret_texts(rng, n):
    out = []
    for k in range(n):
        parts = [rng.choice([
            "word", "Été", "token: ", "PassWord='", "api_key = ", "apikey=", "secret\":\"", "passwd==", "AKIA" + token(rng, rng.choice([5, 16, 20]), UPPER + DIGITS), token(rng, rng.choice([8, 24, 40, 64]), DIGITS + "abcdef"),
            token(rng, rng.choice([20, 32, 44, 90]), LOWER + UPPER + DIGITS), token(rng, rng.choice([24, 43, 86]), LOWER + UPPER + DIGITS + "-_") + "==", token(rng, 30, LOWER), "abcdef0123456789abcdef0123456789",
            "some-long-hyphen-word-2021-version", "InternationaleZusammenarbeit2020", "token: token: abcdefg", "\n", "𝔘", "/usr/local/lib/python3/site-packages/x", "AAAAAAAAAAAAAAAAAAAAAAAA0"]) for _ in range(rng.randrange(8))]
        out.append((k, rng.choice([" ", "", "\n"]).join(parts)))
    return out


def test_secrets_match_brute_force(spark):
    rng = random.Random(3)
    rows = [(None, None), (1, ""), (1, "x"), (None, "token=abcdef"), *secret_texts(rng, 250)]
    rows += [rows[20], rows[20], (900, "key " + token(rng, 3000, LOWER + UPPER + DIGITS + "+/") + " a" * 30_000 + " " + " ".join(token(rng, 30, "abcdef" + DIGITS) for _ in range(1500)))]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, hex int, spans string, candidates string")
    got = sorted((tuple(r)[:6] for r in secret_spans(df).collect()), key=str)
    want = secrets_brute.scan(rows)
    assert got == sorted(want, key=str)
    assert sum("random" in r[5] for r in want) > 30
    assert secret_spans(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_secrets_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = sorted(tuple(r)[:6] for r in secret_spans(docs).collect())
    assert got == sorted(secrets_brute.scan([tuple(r) for r in docs.collect()]))


def test_planted_random_strings_are_found_and_ordinary_ones_left(spark):
    """Recall on planted keys of 32 and of 40 to 64 characters, and the share of ordinary long strings among the reported."""
    rng = random.Random(8)
    planted = [token(rng, n, a) for n in (32, 40, 48, 64) for a in (DIGITS + "abcdef", LOWER + UPPER + DIGITS, UPPER + "234567", LOWER + DIGITS) for _ in range(25)]
    words = ["connection", "Handler", "2021", "manager", "Version", "internal", "service", "Request", "config", "03", "backend", "test"]
    ordinary = ["".join(rng.choice(["_", "-", "/", ""]) + rng.choice(words) for _ in range(rng.randrange(4, 8))) for _ in range(400)]
    rows = [(i, f"key {t} end") for i, t in enumerate(planted + ordinary)]
    found = {r.doc_id for r in secret_spans(spark.createDataFrame(rows, "doc_id long, text string")).where("n_random > 0").collect()}
    short, long = sum(i < 100 for i in found), sum(100 <= i < 400 for i in found)
    assert short >= 0.5 * 100 and long >= 0.9 * 300 and len(found) - short - long <= secrets.FALSE_SHARE * len(found)
