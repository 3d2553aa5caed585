"""Personal data in texts, also where it is disguised, with spans in the text's own characters.

Plain patterns give the base spans. Then transducers rewrite the text piece by piece: look-alike characters to ASCII,
invisible ones to nothing, spelled digits to digits, at/dot disguises to their signs. Each rewritten character keeps
the span of source characters it stands for, so what the patterns find there is mapped back exactly.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import own_columns, text_or_empty

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a leftmost greedy match always begins where its digits begin
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DOTTED = re.compile(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like ASCII ones, and what is not seen at all.
_ALIKE = dict(zip("аеорсухіјѕԁһӏАВЕКМНОРСТУХІЈЅαοενικρτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧı․。｡﹒＠﹫", "aeopcyxijsdhlABEKMHOPCTYXIJSaoevikptuxABEZHIKMNOPTYXi....@@"))
_UNSEEN = "­​‌‍⁠﻿"
_DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

_DIGIT = "(?:" + "|".join(_DIGIT_WORDS) + ")"
# numbers before the first digit word are digits already
_SPELLED = re.compile(rf"(?<![A-Za-z0-9]){_DIGIT}(?:(?:[\s.-]{{1,2}}|\x20dot\x20)(?:{_DIGIT}(?![A-Za-z])|[0-9]+))+", re.I)
_SPELLED_PART = re.compile(rf"({_DIGIT})(\s(?={_DIGIT}))?|\x20(dot)\x20", re.I)
_SIGN = re.compile(r"[(\[{<]\s*(at|dot|punkt|arroba|punto|point|[@.])\s*[)\]}>]\s*", re.I)
_BARE_AT = re.compile(r"(?<!\s)\s+at(?=(\s+)[A-Za-z0-9-])", re.I)
_BARE_DOMAIN = re.compile(r"[A-Za-z0-9-]+((?:\s+dot\s+[A-Za-z0-9-]+)+)(?!\w)", re.I)
_DOT_WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")
_BARE_DOTS = re.compile(r"(?<=[A-Za-z0-9._%+-])@[A-Za-z0-9.-]+((?:(?<=[A-Za-z0-9])\s+(?i:dot)\s+(?=[A-Za-z0-9])[A-Za-z0-9.-]+)+)")
_OTHER = re.compile(rf"[^\x00-ɏ]|[{_UNSEEN}ı]")
_FOLDED = str.maketrans("ſİı", "sii")  # what matches s and i without regard to case


def _luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain patterns, leftmost and not overlapping within a kind."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            last = m.end()
            out.append((start, 0, last))
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text) if _DOTTED.search(text) else ():
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


class Rewritten:
    """A text under rewriting; starts and ends are each character's source span, changed says it is not as it was."""

    def __init__(self, text: str):
        self.text = text
        self.start, self.end = np.arange(len(text)), np.arange(1, len(text) + 1)
        self.changed = np.zeros(len(text), bool)

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Edits (from, to, new) in order, without overlap."""
        if not edits:
            return
        parts, arrays, at = [], [], 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            arrays.append((self.start[at:a], self.end[at:a], self.changed[at:a]))
            arrays.append((np.full(len(new), self.start[a]), np.full(len(new), self.end[b - 1]), np.ones(len(new), bool)))
            at = b
        parts.append(self.text[at:])
        arrays.append((self.start[at:], self.end[at:], self.changed[at:]))
        self.text = "".join(parts)
        self.start, self.end, self.changed = (np.concatenate(x) for x in zip(*arrays))


def _alike(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in () if text.isascii() else _OTHER.finditer(text):
        c = m[0]
        if c in _UNSEEN:
            new = ""
        elif c in _ALIKE:
            new = _ALIKE[c]
        elif (d := unicodedata.decimal(c, None)) is not None:
            new = str(d)
        else:
            new = unicodedata.normalize("NFKC", c)
            if len(new) != 1 or not new.isascii():
                continue
        out.append((m.start(), m.end(), new))
    return out


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Digits for digit words; the spaces between two of them go."""
    out = []
    for m in _SPELLED.finditer(text):
        for w in _SPELLED_PART.finditer(m[0]):
            a = m.start() + w.start()
            if w[3]:
                out.append((a, m.start() + w.end(), "."))
                continue
            out.append((a, m.start() + w.end(1), _DIGIT_WORDS[w[1].translate(_FOLDED).lower()]))
            if w[2]:
                out.append((m.start() + w.start(2), m.start() + w.end(2), ""))
    return out


def _dots_before(text: str, last: int, at: int) -> list[tuple[int, int]] | None:
    """Places of the bare "dot"s in the words that end at `at`, none before `last`; null if no address can begin there.
    An address begins after a sign in its first word, or where no letter, dot or "@" stands before that word."""
    dots, enough, letters = [], None, _LOCAL
    while True:
        start = at
        while start > last and text[start - 1] in letters:
            start -= 1
        if start == at:
            break
        before = text[start - 1] if start else " "
        if not (before.isalnum() or before in "_@.") or any(c in "%+-" for c in text[start : at - 1]):
            enough = len(dots)
        # "word dot " before it
        end = start
        while end > last and text[end - 1].isspace():
            end -= 1
        if end == start or end - 3 <= last or text[end - 3 : end].lower() != "dot" or not text[end - 4].isspace():
            break
        at = end - 3
        while at > last and text[at - 1].isspace():
            at -= 1
        dots.append((at, start))
        letters = _DOT_WORD
    return None if enough is None else dots[:enough]


def _signs(text: str) -> list[tuple[int, int, str]]:
    out, last, low = [], 0, text.lower()
    for m in _SIGN.finditer(text):
        a = m.start()
        while a > last and text[a - 1].isspace():
            a -= 1
        last = m.end()
        out.append((a, last, "@" if m[1].lower() in ("at", "arroba", "@") else "."))
    last = 0
    for m in _BARE_AT.finditer(text) if "dot" in low else ():
        domain = _BARE_DOMAIN.match(text, m.end(1)) if m.start() > last else None
        dots = _dots_before(text, last, m.start()) if domain else None
        if dots is not None:
            last = domain.end()
            out += [(m.start(), m.end(1), "@"), *[(a, b, ".") for a, b in dots]]
            out += [(domain.start(1) + d.start(), domain.start(1) + d.end(), ".") for d in re.finditer(r"\s+dot\s+", domain[1], re.I)]
    if "plus" in low:
        out += [(m.start(), m.end(), "+") for m in re.finditer(r"\bplus\s+(?=[0-9])", text, re.I)]
    kept, last = [], 0
    for edit in sorted(set(out)):
        if edit[0] >= last:
            kept.append(edit)
            last = edit[1]
    return kept


def _bare_dots(text: str) -> list[tuple[int, int, str]]:
    """Bare "dot", any number of them, after an address that has its sign already."""
    found = _BARE_DOTS.finditer(text) if "@" in text else ()
    return [(m.start(1) + d.start(), m.start(1) + d.end(), ".") for m in found for d in re.finditer(r"\s+dot\s+", m[1], re.I)]


def find_disguised(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that only the rewritten text shows: with a rewritten character inside, and clear of base spans of the kind."""
    new = Rewritten(text)
    for transducer in (_alike, _spelled, _signs, _bare_dots):
        new.replace(transducer(new.text))
    if not new.changed.any():
        return []
    out = []
    for start, kind, end in find(new.text):
        if new.changed[start:end].any():
            a, b = int(new.start[start]), int(new.end[end - 1])
            if not any(k == kind and a < e and s < b for s, k, e in base):
                out.append((a, kind, b))
    return out


def _named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def personal_data(df: DataFrame) -> DataFrame:
    """For each row of `df` (doc_id, text; others ignored): doc_id, n_email, n_ip, n_card, n_phone (plain ones),
    base_sha256, spans (plain and disguised), n_disguised.

    A null text is empty. Spans are in code points, end exclusive; ties are in the order of KINDS. A null or repeated
    doc_id is a row like others; an empty table gives no rows.
    """
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, more = [], [], [], []
            for text in batch.column(1).to_pylist():
                base = find(text)
                extra = find_disguised(text, base)
                counts.append([sum(k == i for _, k, _ in base) for i in range(len(KINDS))])
                digests.append(hashlib.sha256(_named(base).encode()).hexdigest())
                spans.append(_named(base + extra))
                more.append(len(extra))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))], pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(more, pa.int64())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_disguised"])

    rows = own_columns(df, "doc_id", "text").select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, schema)
