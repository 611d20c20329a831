"""Plain versions of the operators, for small inputs: (id, text) in, tuples out."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def lowered(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def suffix(docs: list[tuple[int, str | None]], length: int) -> list[tuple]:
    seen: set[bytes] = set()
    out = []
    for i, text in docs:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - length + 1):
            window = body[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        left = bytes(c for c, g in zip(body, gone, strict=True) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        out.append((i, len(body), sum(gone), spans, sha(left)))
    return out


def substrings(docs: list[tuple[int, str | None]], length: int) -> list[tuple]:
    split = [(i, re.findall(WORD, t or "")) for i, t in docs]
    count = Counter(tuple(w[p : p + length]) for _, w in split for p in range(len(w) - length + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if count[tuple(w[p : p + length])] > 1:
                gone[p : p + length] = [True] * length
        left = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), sha(left.encode())))
    return out


def fingerprint(text: str | None) -> int:
    w = re.findall(WORD, lowered(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: dict[int, int], distance: int = 3) -> dict[int, int]:
    parent = {i: i for i in prints}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if b < a and (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def measures(text: str | None) -> tuple[int, int, int, int, int, bool]:
    text = text or ""
    w = re.findall(WORD, text)
    windows = Counter(tuple(w[p : p + 8]) for p in range(len(w) - 7))
    covered = {p + k for p in range(len(w) - 7) if windows[tuple(w[p : p + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(w) < 20 or 100 * len(covered) > 30 * len(w),
    )
