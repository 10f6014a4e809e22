"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def words(t):
    return WORD.findall(t or "")


def dedup(rows, width=35):
    """[(doc_id, n_words, n_removed, sha)]"""
    seen, lists = Counter(), [words(t) for _, t in rows]
    for w in lists:
        seen.update(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, lists):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def quality(t):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    w = words(t)
    lines = [x for x in (t or "").split("\n") if words(x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def kept(rows):
    """Verdict for each (text, lang, source)."""
    stats = [quality(t) for t, _, _ in rows]
    lines = [len([x for x in (t or "").split("\n") if words(x)]) for t, _, _ in rows]
    ratios = [(1000 * s[2] // max(s[1], 1), 1000 * s[3] // max(k, 1), 1000 * s[4] // max(s[0], 1), min(100 * s[1] // max(s[0], 1), 10000)) for s, k in zip(stats, lines)]
    groups = defaultdict(list)
    for (_, lang, source), s, r in zip(rows, stats, ratios):
        if not s[-1]:
            groups[lang, source].append(r)
    at = lambda g, i, q: sorted(r[i] for r in g)[-(-q * len(g) // 1000) - 1]
    rules = ((0, 1, 750, 250, 3), (1, 1, 980, 900, 1), (2, 1, 980, 900, 1), (3, 1, 750, 250, 3), (3, -1, 250, 750, 3))
    spread = lambda g, i, q, inner: abs(at(g, i, q) - at(g, i, inner))
    mid = [sorted(spread(g, i, q, inner) for g in groups.values())[(len(groups) + 1) // 2 - 1] for i, _, q, inner, _ in rules]
    inside = lambda g, r: all(sign * (r[i] - at(g, i, q)) <= f * max(spread(g, i, q, inner), m) + 1 for (i, sign, q, inner, f), m in zip(rules, mid))
    return [not s[-1] and inside(groups[lang, source], r) for (_, lang, source), s, r in zip(rows, stats, ratios)]


def secrets(t):
    """[(start, kind number, kind, end)]"""
    t = t or ""
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 32]
    return sorted(out)


def shingles(t, k=3):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def jaccard(rows):
    """[(doc_id, n_shingles, component_id)]"""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * n >= 90 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    least = {k: min([x for x in v if x is not None], default=None) for k, v in ids.items()}
    return [(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def chained(hashes, start=42):
    """A row of 64-bit hashes as one: each one's bytes hashed with the hash before as seed."""
    for h in hashes:
        start = xxhash.xxh64_intdigest(struct.pack("<q", h), seed=start % (1 << 64))
    return start - (1 << 64) if start >> 63 else start


def sketch(t, k=5, fraction=4):
    """All hashes of k-word shingles in the lowest part of the range, or the lowest of all."""
    own = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words(t)]
    own = [h - (1 << 64) if h >> 63 else h for h in own]
    full = {chained(own[i : i + k]) for i in range(len(own) - k + 1)} if len(own) >= k else {chained(own)} if own else set()
    return sorted(h for h in full if h < -(1 << 63) + (1 << 64) // fraction) or sorted(full)[:1]


def contained(a, b):
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    return len(set(a) & set(b)) / min(len(a), len(b))


def rates(sizes, target, cap=3):
    """Expected copies by size: the bounded tilt whose total meets the target, by bisection."""
    mean = max(1.0, sum(s * n for s, n in sizes.items()) / max(1, sum(sizes.values())))
    rate = lambda s, lam: cap / (1 + (cap - 1) * math.exp(max(-700.0, min(700.0, -lam * s / mean)))) if s else 0.0
    low, high = -4096.0, 4096.0
    for _ in range(200):
        lam = (low + high) / 2
        low, high = (lam, high) if sum(rate(s, lam) * s * n for s, n in sizes.items()) < target else (low, lam)
    return {s: rate(s, low) for s in sizes}
