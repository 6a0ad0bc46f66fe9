"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def repeats(rows: list[tuple[int, str | None]], window: int) -> dict[int, tuple[int, int, str]]:
    first, split = {}, {i: words(t) for i, t in rows}
    for i in sorted(split):
        for p in range(len(split[i]) - window + 1):
            first.setdefault(b" ".join(split[i][p : p + window]), i)
    out = {}
    for i, w in split.items():
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[b" ".join(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def shingles(text: str | None, k: int = 5) -> dict[tuple, int]:
    w = words((text or "").lower())
    grams = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] if w else []
    out: dict[tuple, int] = {}
    for g in grams:
        out[g] = out.get(g, 0) + 1
    return out


def probability_jaccard(a: dict, b: dict) -> float:
    """By definition, with one sum per common element."""
    every = set(a) | set(b)
    return sum(1 / sum(max(a.get(d, 0) / a[k], b.get(d, 0) / b[k]) for d in every) for k in set(a) & set(b))


def near_classes(rows: list[tuple[int, str | None]], similarity: float = 0.8) -> dict[int, int]:
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a].keys() & sets[b].keys())
            if common and find(a) != find(b) and probability_jaccard(sets[a], sets[b]) >= similarity:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def token_list(text: str | None) -> list[str]:
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def tiling(doc: list[str], item: list[str], least: int) -> int:
    """Marked item tokens by greedy string tiling, searching every match anew each round."""
    in_doc, in_item, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and i + n not in in_doc and j + n not in in_item:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return total
        n, i, j = best
        in_doc |= set(range(i, i + n))
        in_item |= set(range(j, j + n))
        total += n


def token_rows(rows: list[tuple[int, str | None]], tokenizer, end: int = 1) -> dict[int, tuple[int, int, int]]:
    """start, n_tokens and crc per id, ids distinct."""
    at, out = 0, {}
    for i, t in sorted(rows):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]
        out[i] = (at, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))
        at += len(ids)
    return out
