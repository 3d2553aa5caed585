"""Naive Bayes: the even sample, priors over all labelled rows, and a plain version over counters of hashed grams."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import language

SCHEMA = "doc_id long, text string, lang string"


def sentences(rng, letters, n, words=12):
    return [" ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(words)) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = [(t, "aa") for t in sentences(rng, "abcdefgh", 900)] + [(t, "bb") for t in sentences(rng, "efghijkl", 700)] + [(t, "cc") for t in sentences(rng, "mnopqrst", 12)]
    return [(i, t, lang) for i, (t, lang) in enumerate(texts)]


def test_shares_take_rare_languages_whole():
    assert language.shares({"a": 5, "b": 2000, "c": 1000}, 305) == {"a": 1.0, "b": 150 / 2000, "c": 150 / 1000}
    assert language.shares({"a": 5, "b": 7}, 100) == {"a": 1.0, "b": 1.0}
    assert language.shares({}, 100) == {}


def test_a_rare_language_is_learned_from_a_small_sample(spark, rows):
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, SCHEMA), train_rows=90).collect()}
    rare = [got[i].lang_pred for i, _, lang in rows if lang == "cc"]
    assert rare == ["cc"] * len(rare)
    right = [got[i].lang_pred == lang for i, _, lang in rows if got[i].held_out]
    assert sum(right) / len(right) > 0.95
    _, priors, _ = language.learn(spark.createDataFrame(rows, SCHEMA), 90)
    assert np.allclose(np.exp(priors), np.array([900, 700, 12]) / 1612)


def test_scores_equal_plain_naive_bayes(spark, rows):
    def grams(text):
        return Counter(int(b) for bins, begins, ends in language._grams([text.lower()], np.array([len(text)])) for b in bins[begins[0]:ends[0]])

    part = rows[::9]
    model = language.learn(spark.createDataFrame(part, SCHEMA))
    counts, n = {}, Counter(lang for *_, lang in part)
    for _, text, lang in part:
        counts.setdefault(lang, Counter()).update(grams(text))
    langs = sorted(counts)
    assert model[0] == langs
    for row in language.predict(spark.createDataFrame(part[::5], SCHEMA), model, ["doc_id", "text"]).collect():
        seen = grams(row.text)
        log = [math.log(n[lang] / len(part)) + sum(
            k * math.log((counts[lang][g] + 0.5) / (sum(counts[lang].values()) + 0.5 * language.BINS)) for g, k in seen.items()) for lang in langs]
        top = max(range(len(langs)), key=lambda i: log[i])
        assert row.lang_pred == langs[top]
        assert row.score == pytest.approx(1 / sum(math.exp(v - log[top]) for v in log), abs=1e-3)


def test_many_languages_are_scored_in_small_chunks(spark, rows, monkeypatch):
    model = language.learn(spark.createDataFrame(rows, SCHEMA))
    df = spark.createDataFrame([(1, rows[0][1] * 30, None), (2, rows[1000][1], "x"), (3, "", None), (4, None, None)], SCHEMA)
    whole = sorted(map(tuple, language.predict(df, model).collect()))
    monkeypatch.setattr(language, "CELLS", 60)
    cut = sorted(map(tuple, language.predict(df, model).collect()))
    assert [r[:2] for r in cut] == [r[:2] for r in whole] == [(1, "aa"), (2, "bb"), (3, "und"), (4, "und")]
    assert np.allclose([r[2] for r in cut], [r[2] for r in whole], atol=1e-3)


def test_tables_without_rows_or_labels_and_clashing_columns(spark):
    assert language.identify(spark.createDataFrame([], SCHEMA)).collect() == []
    assert language.with_known_language(spark.createDataFrame([], SCHEMA)).collect() == []
    plain = spark.createDataFrame([(1, "some words", None), (2, None, None)], SCHEMA)
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in language.identify(plain).collect()) == [(1, "und", 0.0), (2, "und", 0.0)]
    named = spark.createDataFrame([(i, "words here", "aa", "x", 1) for i in range(1, 9)], SCHEMA + ", lang_pred string, score int")
    assert language.identify(named).columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert {r.lang_pred for r in language.identify(named).collect()} == {"aa"}
    assert language.with_known_language(named).columns == named.columns
