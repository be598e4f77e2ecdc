"""Plain versions of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def private(text: str | None) -> dict[str, list[tuple[int, int]]]:
    text, digits = text or "", lambda m: re.sub("[^0-9]", "", m[0])
    found = lambda p: re.finditer(p, text)
    return {
        "email": [m.span() for m in found(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")],
        "ip": [m.span() for m in found(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in found(r"[0-9]([\x20-]?[0-9])+") if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in found(r"\+[0-9][\x20().0-9-]+[0-9]") if 9 <= len(digits(m)) <= 15],
    }


def secret(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    rule = r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [("assign", *m.span()) for m in re.finditer(rule, text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def spans_text(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def shingles(text: str | None, width: int) -> frozenset:
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(sets: list[frozenset], num: int, den: int) -> list[int]:
    """For each set the least place it is connected with."""
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * den >= num * max(len(a), len(b)):
                common = len(a & b)
                if den * common >= num * (len(a) + len(b) - common):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Shares by weight, held at three times a source's size, again and again."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    out, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = 3.0 * sizes[s]
        left -= sum(3.0 * sizes[s] for s in over)
        open_ -= set(over)
    return out


def fold(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def best(vectors: list[tuple[int, list[int]]], query: tuple[int, list[int]], k: int = 5) -> list[tuple[int, int]]:
    longest = (1 << 63) - 1
    scored = [(-max(-longest, min(longest, sum(a * b for a, b in zip(query[1], v)))), i) for i, v in vectors if i != query[0] and len(v) == len(query[1])]
    return [(i, -s) for s, i in sorted(scored)[:k]]


def terms(text: str | None) -> list[str]:
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranked(texts: list[tuple], queries: dict, k: int) -> dict:
    """For each query its best (rank, doc_id, score)."""
    held = [(i, Counter(t), len(t)) for i, t in texts if t]
    n_all, all_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = {}
    for q, words in queries.items():
        scored = []
        for i, c, n in held:
            m = 10 + (90 * n * n_all) // all_terms
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in words if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out[q] = [(r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return out


def runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    found: dict[tuple[int, int], int] = {}
    n, number = len(words), {w: i for i, w in enumerate(words)}
    codes = np.array([number[w] for w in words], np.int32)
    for p in range(1, n // 4 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (codes[:-p] == codes[p:]).view(np.int8), [0]])))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(doc_id: int | None, text: str | None) -> tuple:
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = runs(words)
    again = {i for s, length, p in found for i in range(s + p, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *four, sha("".join(f"{s},{length},{p}\n" for s, length, p in found)), sha(" ".join(w for i, w in enumerate(words) if i not in again)))


def counted(rows) -> Counter:
    return Counter(map(tuple, rows))
