"""Places where an operator once did less than its whole job."""

import pytest

from tidemark.llm.decontaminate import _fingerprints, contamination
from tidemark.llm.html_text import extract, main_text
from tidemark.llm.pii import KINDS, find, find_disguised


@pytest.mark.parametrize("more", ["", " ’", " dot", "\nплюс"])
@pytest.mark.parametrize("text, kind, span", [
    ("call +1 555 one two 34567", "phone", "+1 555 one two 34567"),
    ("call +1 555 one 23 4567", "phone", "+1 555 one 23 4567"),
    ("card 4111 one one 11 1111 1111", "card", "4111 one one 11 1111 1111"),
    ("card 4111 one 111 1111 1111", "card", "4111 one 111 1111 1111"),
    ("host 10.two.3.4", "ip", "10.two.3.4"),
    ("call plus\t1 555 123 4567", "phone", "plus\t1 555 123 4567"),
    ("call PLUS\n1 555 123 4567", "phone", "PLUS\n1 555 123 4567"),
    ("joe (\tAT ) mail [ dot]\ncom", "email", "joe (\tAT ) mail [ dot]\ncom"),
    ("joe@mail dot a dot b dot com", "email", "joe@mail dot a dot b dot com"),
    ("joe@mail dot a dot b dot c dot d", "email", "joe@mail dot a dot b dot c dot d"),
    (f"joe@{'x' * 100} dot com", "email", f"joe@{'x' * 100} dot com"),
])
def test_disguises_do_not_hang_on_unrelated_text(text, kind, span, more):
    text = f"{more}; {text};{more}"
    assert [(KINDS[k], text[a:b]) for a, k, b in find_disguised(text, find(text))] == [(kind, span)]


@pytest.mark.parametrize("word", ["ſix", "fıve", "nİne"])
def test_odd_cases_of_digit_words(word):
    text = f"call +1 555 123 {word} two three four’"
    assert [(KINDS[k], text[a:b]) for a, k, b in find_disguised(text, find(text))] == [("phone", text[5:-1])]


@pytest.mark.parametrize("text", [
    " ".join(str(i % 997) for i in range(250_000)), "dot " + "-" * 1_000_000, "dot x" + " " * 1_000_000 + "at", "a dot " * 170_000 + "b at c dot d",
    "dot " + "a at b " * 140_000, "plus " * 200_000, "one " * 60_000,
], ids=["numbers", "dashes", "blanks", "dots", "ats", "plus", "words"])
def test_a_megabyte_takes_seconds(text):
    import time

    start = time.process_time()
    find_disguised(text, find(text))
    assert time.process_time() - start < 8


@pytest.mark.parametrize("text, spans", [
    ("joe at AT at mail dot com", ["AT at mail dot com"]),
    ("éa dot b-c at mail dot com", ["b-c at mail dot com"]),
    ("x dot y dot z at mail dot com dot", ["x dot y dot z at mail dot com"]),
    ("call plus one two\nthree four five six seven eight nine one two", ["plus one two\nthree four five six seven eight nine one two"]),
    ("at dot com", []),
])
def test_where_bare_addresses_begin(text, spans):
    assert [text[a:b] for a, _, b in find_disguised(text, find(text))] == spans


def story(name, n):
    return [f"{name}{i} " + "words of the story that go on for quite a while, " * 5 + "end." for i in range(n)]


def paragraphs(lines):
    return "".join(f"<p>{x}</p>" for x in lines)


PAGE = "<html><body><nav><ul><li><a>One</a></ul></nav>%s<div class=ad>Buy</div><ul><li><a>x</a><li><a>y</a></ul><footer>Foot</footer></body></html>"
A, B, C, LONG = story("a", 6), story("b", 4), story("c", 6), story("d", 30)


@pytest.mark.parametrize("body, lines", [
    (f"<article>{paragraphs(A)}</article><article>{paragraphs(B)}</article>", A + B),
    (f"<article>{paragraphs(A)}</article><article>{paragraphs(C)}</article>", A + C),
    (f"<article>{paragraphs(A)}</article><article>{paragraphs(B)}</article><article>{paragraphs(C)}</article>", A + B + C),
    (f"<h1>Title</h1><article>{paragraphs(A)}</article>", ["Title", *A]),
    (f"<h1>Title</h1><div class=content>{paragraphs(A)}</div>", ["Title", *A]),
    (f"<div class=top><h1>Title</h1></div><div class=content>{paragraphs(A)}</div><div class=end><h2>End</h2><p>Short.</p></div>", ["Title", *A, "End", "Short."]),
    (f"<div class=content>{paragraphs(LONG)}</div><div class=end>{paragraphs(B[:1])}</div>", LONG + B[:1]),
    (f"<article>{paragraphs(LONG)}</article><div class=end>{paragraphs(B[:1])}</div>", LONG + B[:1]),
])
def test_main_text_keeps_every_content_region(body, lines):
    assert main_text(PAGE % body).split("\n") == [" ".join(x.split()) for x in lines]


@pytest.mark.parametrize("name", ["social-history", "related-work", "search-methods"])
def test_articles_keep_elements_whose_names_only_begin_like_excluded_ones(name):
    body = f"<article>{paragraphs(A)}<p class={name}>{C[0]}</p><div class={name}>{paragraphs(C[1:2])}</div><div class=ad>Buy</div></article>"
    assert main_text(PAGE % body).split("\n") == [" ".join(x.split()) for x in A + C[:2]]


def test_a_list_article_beside_prose_is_kept():
    items = [f"item {k}" for k in range(200)]
    body = f"<article><ul>{''.join(f'<li><b>{x}</b></li>' for x in items)}</ul></article><div class=story>{paragraphs(LONG)}</div>"
    assert main_text(PAGE % body).split("\n") == items + [" ".join(x.split()) for x in LONG]


@pytest.mark.parametrize("page", [
    "<div>" * 90_000 + "some text of the page" + "</div>" * 90_000,
    "<b>" * 90_000 + "<div>some text of the page</div>" * 20_000,
    "<b>" * 60_000 + "<p>some text of the page</i></u>" * 20_000,
    "<i><div>" + "<b>" * 60_000 + "some text of the page" + "</i>" * 60_000,
    "<p>some text of the page" * 40_000,
])
def test_deep_and_long_pages_take_linear_time(page):
    import time

    start = time.process_time()
    assert "some text of the page" in main_text(page)
    assert time.process_time() - start < 12


def test_pages_of_an_empty_table_and_clashing_columns(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, region int"
    assert extract(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "u", "<p>one two</p>", "x", "y", 3), (1, None, None, "x", "y", 3), (None, "u", "", None, None, None)]
    got = extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([(1, "u", "one two", 7), (1, None, "", 0), (None, "u", "", 0)], key=str)


def test_very_long_benchmark_items(spark):
    long, equal = " ".join(f"v{k}" for k in range(70_000)), "same " * 40_000
    items = spark.createDataFrame([(1, long), (2, equal), (3, "some short item of seven words here")], "item_id long, text string")
    rows = [(1, long + " and more"), (2, equal), (3, long[: len(long) // 2]), (4, "so some short item of seven words here is"), (5, "nothing")]
    got = contamination(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (2, 2), (3, None), (4, 3), (5, None)]


def test_fingerprints_count_each_bit_by_itself(spark):
    values = {1: [-1] * 70_000 + [0] * 69_999, 2: [-1] * 70_000 + [0] * 70_000, 3: [1 << 62, 5, 5 | -1 << 63], 4: [6 - (1 << 63)]}
    rows = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k int, shingle long")
    assert sorted(tuple(r) for r in _fingerprints(rows, "k").collect()) == [(1, -1), (2, 0), (3, 5), (4, 6 - (1 << 63))]
