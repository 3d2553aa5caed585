"""The prefix trie re-stated on plain dictionaries."""

import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def trie(rows, key=None):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) from (conv_id, turn, role, text)."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, (role or "", text or "")))
    turns = {c: [t[2] for t in sorted(ts, key=lambda t: (t[0], t[1], key(t[2]) if key else 0))] for c, ts in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    members, ends = {}, {}
    for c, s in built.items():
        ends.setdefault(s, []).append(c)
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) or 1
        saved[p] = sum(saved[k] for k in below) + ((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0)
    return [
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, m in members.items()]
