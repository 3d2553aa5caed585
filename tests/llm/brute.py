"""Plain re-statements of the operators' contracts, one document or pair at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _covered(symbols: list, length: int, windows: Counter) -> list[bool]:
    gone = [False] * len(symbols)
    for p in range(len(symbols) - length + 1):
        if windows[tuple(symbols[p : p + length])] > 1:
            gone[p : p + length] = [True] * length
    return gone


def _windows(docs: list[list], length: int) -> Counter:
    return Counter(tuple(d[p : p + length]) for d in docs for p in range(len(d) - length + 1))


def byte_repeats(rows: list[tuple], length: int = 400) -> list[tuple]:
    docs = [list((t or "").encode()) for _, t in rows]
    windows, out = _windows(docs, length), []
    for (i, _), d in zip(rows, docs):
        gone = _covered(d, length, windows)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(d, gone) if not g)).hexdigest()))
    return out


def word_repeats(rows: list[tuple], length: int = 35) -> list[tuple]:
    docs = [WORD.findall((t or "").encode()) for _, t in rows]
    windows, out = _windows(docs, length), []
    for (i, _), d in zip(rows, docs):
        gone = _covered(d, length, windows)
        out.append((i, len(d), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(d, gone) if not g)).hexdigest()))
    return out


def shingles(text: str | None, n: int = 5) -> set[tuple]:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode())
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def similar(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group[root(i)] = root(j)
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [(doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)]


def leaks(text: str | None, items: list[tuple]) -> list[tuple]:
    """(item_id, similarity) of the items that a window of their length is similar to, by weighted Jaccard of five-word
    shingles; the similarity is that of the best window."""
    def grams(words, n):
        return Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1))

    words, out = (text or "").lower().split(), []
    for item_id, item in dict.fromkeys(items):
        w = (item or "").lower().split()
        if not w or not words:
            continue
        n, best = min(5, len(w)), (0, 1)
        want = grams(w, n)
        for s in range(max(1, len(words) - len(w) + 1)):
            have = grams(words[s : s + len(w)], n)
            both, union = (have & want).total(), (have | want).total()
            if both * best[1] > best[0] * union:
                best = both, union
        if 100 * best[0] >= 80 * best[1]:
            out.append((item_id, best[0] / best[1]))
    return out


def leaked(rows: list[tuple], items: list[tuple]) -> list[bool]:
    """Whether any window of an item's length is similar to it."""
    return [bool(leaks(text, items)) for _, text in rows]


_KINDS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def personal(text: str) -> list[tuple[int, int, int]]:
    out = []
    for kind, pattern in enumerate(_KINDS):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            luhn = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))) % 10 == 0
            if (kind == 0 or kind == 1 and all(int(x) <= 255 for x in m[0].split(".")) or kind == 2 and 14 <= len(digits) <= 19 and luhn or kind == 3 and 10 <= len(digits) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)
