import hashlib
import random
import zlib

import brute
import pytest

from tidemark.llm.decontaminate import contamination
from tidemark.llm.exact import exact_duplicates, without_duplicates
from tidemark.llm.html_text import extract, main_text
from tidemark.llm.jaccard import similar_documents, without_near_copies
from tidemark.llm.language import identify
from tidemark.llm.packing import configurations, pack
from tidemark.llm.pii import KINDS, find, find_disguised, personal_data
from tidemark.llm.sharding import shard_documents


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_personal_data_matches_plain_patterns():
    rng = random.Random(1)
    for _ in range(8000):
        text = "".join(rng.choice("ab1290.@+- ()%é") for _ in range(60))
        assert find(text) == brute.personal(text)


@pytest.mark.parametrize("text, kind, span", [
    ("write to john (at) example [dot] com now", "email", "john (at) example [dot] com"),
    ("mail john dot doe at example dot com now", "email", "john dot doe at example dot com"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("call plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
    ("four one one one 1111 1111 1111", "card", "four one one one 1111 1111 1111"),
    ("host one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
])
def test_disguised_data_maps_back_to_source(text, kind, span):
    assert [(KINDS[k], text[a:b]) for a, k, b in find_disguised(text, find(text))] == [(kind, span)]


def test_clean_texts_stay_clean():
    for text in ("meet at noon dot", "one two three things", "stone two oneself", "élan vital", "at the dot com crash"):
        assert find_disguised(text, find(text)) == []


def test_personal_data_rows(frame, odd_rows):
    got = personal_data(frame([*odd_rows, (900, "a@b.c 1.2.3.4")])).collect()
    assert len(got) == len(odd_rows) + 1
    row = next(r for r in got if r.doc_id == 900)
    assert row.spans == "email:0:5,ip:6:13" and row.base_sha256 == hashlib.sha256(row.spans.encode()).hexdigest() and (row.n_email, row.n_ip) == (1, 1)


def test_shards_are_even_gapless_and_keep_copies_together(frame, odd_rows):
    for rows in (odd_rows, [*odd_rows, *[(1000 + i, "hot copy of one text") for i in range(30)]]):
        got = shard_documents(frame(rows)).collect()
        counts = [sorted(r.slot for r in got if r.shard == s) for s in range(8)]
        assert sum(map(len, counts)) == len(rows) and max(map(len, counts)) - min(map(len, counts)) <= 1
        assert all(c == list(range(len(c))) for c in counts)
        assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    assert shard_documents(frame([])).collect() == []


def test_exact_duplicates(frame, odd_rows):
    sets = {}
    for i, t in odd_rows:
        sets.setdefault(t or "", []).append(i)
    expected = []
    for i, t in odd_rows:
        ids = sets[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        expected.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    df = frame(odd_rows)
    assert rows_of(exact_duplicates(df), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(expected, key=str)
    kept = without_duplicates(df)
    assert kept.columns == df.columns and kept.count() == sum(x[3] for x in expected)
    assert exact_duplicates(frame([])).collect() == []


def test_contamination_matches_brute_force(spark, frame, odd_rows):
    rng = random.Random(9)
    items = [(1, odd_rows[12][1][:300]), (2, "w1 w2 w3"), (3, None), (4, ""), (5, " ".join(f"q{k}" for k in range(30))), (5, " ".join(f"q{k}" for k in range(30)))]
    near = [f"q{k}" for k in range(30)]
    rows = [*odd_rows]
    for k in range(12):
        w = list(near)
        for _ in range(k // 3):
            w[rng.randrange(30)] = "x"
        rows.append((500 + k, " ".join(["a b c d"] * k + w + ["e f g"] * k)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows_of(contamination(frame(rows), bench), "doc_id", "contaminated")
    assert got == sorted(((i, x) for (i, _), x in zip(rows, brute.leaked(rows, items))), key=str)
    assert contamination(frame(rows[:3]), bench.limit(0)).where("contaminated").count() == 0


def test_items_and_similarities_match_brute_force(spark, frame):
    """Windows with few and with many changes, items that contain each other, ties, repeated items and rows, empty texts."""
    rng = random.Random(31)
    word = lambda: f"v{rng.randrange(300)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([2, 5, 8, 20, 60, 90, 120])))) for k in range(24)]
    items += [(30, items[3][1]), (31, " ".join(items[4][1].split()[:-1])), items[5], (32, ""), (None, items[6][1])]
    rows = [(900, None), (901, ""), (902, " \n"), (903, items[7][1]), (903, items[7][1])]
    for k in range(150):
        words = items[k % 24][1].split()
        for _ in range(rng.randrange(1 + len(words) // 20)):
            words[rng.randrange(len(words))] = word()
        rows.append((k, " ".join([word() for _ in range(rng.randrange(30))] + words + [word() for _ in range(rng.randrange(30))])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = []
    for i, text in rows:
        found = brute.leaks(text, items)
        best = min(((-s, item is not None, item or 0, item) for item, s in found), default=(0.0, None, None, None))
        expected.append((i, bool(found), len(found), best[3], round(-best[0], 9)))
    assert sum(x[2] for x in expected) > 90 and sum(0.8 <= x[4] < 0.95 for x in expected) > 10
    got = [(r.doc_id, r.contaminated, r.n_items, r.item_id, round(r.similarity, 9)) for r in contamination(frame(rows), bench).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_copies_share_a_shard_where_there_is_room(frame):
    """Forty groups of five and one that fills most of a shard: none is cut, as each fits."""
    rows = [(i, f"text {i}") for i in range(600)] + [(1000 + i, f"group {i % 40}") for i in range(200)] + [(2000 + i, "larger group") for i in range(60)]
    text = dict(rows)
    got = shard_documents(frame(rows)).collect()
    held = {}
    for r in got:
        held.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(shards) == 1 for shards in held.values())
    counts = [sum(r.shard == s for r in got) for s in range(8)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1


def test_similar_documents_match_all_pairs(frame, odd_rows):
    df = frame(odd_rows)
    expected = brute.similar(odd_rows)
    assert rows_of(similar_documents(df), "doc_id", "n_shingles", "component_id") == sorted(expected, key=str)
    assert without_near_copies(df).count() == sum(i == c for i, _, c in expected)
    assert similar_documents(frame([])).collect() == []


def test_language_is_learned_from_the_other_rows(spark):
    rng = random.Random(2)
    words = {"en": "the of and to in that with".split(), "fr": "le la des une pour dans est".split()}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(20)), lang) for i, lang in enumerate(["en", "fr"] * 60)] + [(500, None, "en"), (501, "123 !!", "fr"), (502, "", None), (None, "the and of", "en")]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].lang_pred == lang for i, t, lang in rows if i is not None and i < 500)
    assert {got[i].lang_pred for i in (500, 501, 502)} == {"und"} and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got if i is not None)


def test_packing_is_an_exact_round_trip(frame, odd_rows):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = [*odd_rows, (901, "<|endoftext|> naïve 日本語  x y\u0085z 'S 'll"), (902, "a" * 3000)]
    got = pack(frame(rows)).collect()
    expected = []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or min(2048, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        expected += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(expected, key=str)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert pack(frame([])).collect() == []


def test_configurations_hold_the_histogram_in_few_sequences():
    rng = random.Random(4)
    histogram = {rng.randrange(1, 2049): rng.randrange(1, 40) for _ in range(300)}
    plan, seen = configurations(histogram), {}
    for parts, n in plan:
        assert sum(k * v for k, v in parts.items()) <= 2048
        for length, k in parts.items():
            seen[length] = seen.get(length, 0) + k * n
    total = sum(k * v for k, v in histogram.items())
    assert seen == histogram and sum(n for _, n in plan) <= 1.02 * max(total / 2048, sum(v for k, v in histogram.items() if k > 1024))


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Home</a></header><nav><ul><li><a>One</a></ul></nav>
<div class="cookie-notice">We use cookies</div><aside>Side bar with quite a few words in it</aside>%s
<div id="comments"><p>First reader comment that is rather long, longer than most.</p></div><form>Name <input></form><footer>Foot</footer></body></html>"""
BODY = "<h1>Title &amp; more</h1><p><b>Lead  text<br>goes on.<p>Second\n paragraph with a good number of words.</p><div class=ad>Buy</div><ul><li>item one<li>item two</ul>"


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", '<div class="content">%s</div>'])
def test_main_text(wrap):
    assert main_text(PAGE % (wrap % BODY)) == "Title & more\nLead text goes on.\nSecond paragraph with a good number of words.\nitem one\nitem two"


def test_pages_with_nothing(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p></p>"), (3, "u", "<article><p>x</article>"), (3, "u", "no tags")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [(r.text, r.n_chars) for r in got] == [("", 0), ("", 0), ("", 0), ("x", 1), ("no tags", 7)]


def test_language_grams_of_cut_texts_count_once(monkeypatch):
    import numpy as np

    from tidemark.llm import language

    texts = ["abcdefghij" * 7, "", "x", "ab", "Été " * 30]

    def counts():
        out = []
        for _, pieces, counted in language._chunks(texts):
            for bins, begins, ends in language._grams(pieces, counted):
                out += [bins[a:b] for a, b in zip(begins, ends) if b > a]
        return sorted(np.concatenate(out).tolist())

    whole = counts()
    monkeypatch.setattr(language, "CHUNK", 16)
    assert counts() == whole and len(whole) == sum(max(0, len(t) - n + 1) for t in texts for n in language.GRAMS)
