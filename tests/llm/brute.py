"""The contracts of the corpus operators, written plainly for small inputs."""

from __future__ import annotations

import base64
import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text: str | None) -> frozenset:
    words = WORD.findall(lowered(text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(items: list, linked) -> dict:
    """Smallest index reachable by links, by index."""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(len(items))}


def similar(a: frozenset, b: frozenset) -> bool:
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def jaccard_components(docs: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    ids = sorted(docs)
    sets = [shingles(docs[i]) for i in ids]
    found = components(sets, similar)
    return {ids[i]: (len(sets[i]), ids[found[i]]) for i in range(len(ids))}


def without_repeats(docs: dict[int, str | None], size: int = 50) -> dict[int, tuple[int, int, int, str]]:
    first: dict[bytes, int] = {}
    raw = {i: (docs[i] or "").encode() for i in sorted(docs)}
    for i, b in raw.items():
        for k in range(len(b) - size + 1):
            first.setdefault(b[k : k + size], i)
    out = {}
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if first[b[k : k + size]] < i:
                gone[k : k + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def rule_counts(text: str | None) -> tuple[int, int, int, int, int, bool]:
    text = text or ""
    words = WORD.findall(text)
    seen, dup_lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup_lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = {w for w, n in collections.Counter(windows).items() if n > 1}
    covered = {k for i, w in enumerate(windows) if w in often for k in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup_lines, len(covered), failed


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()
