"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def tokens(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingles(text: str | None, size: int) -> frozenset:
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def groups(rows: list[tuple[int | None, str | None]], size: int, percent: int) -> list[int]:
    """For each row, a number of its group."""
    sets = [shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(rows))]


def passages(text: str | None, items: list[tuple[int | None, str | None]], window: int = 10) -> tuple[int, int, list[str]]:
    w, hit, named = tokens(text), set(), set()
    for item, of in items:
        v = tokens(of)
        n = min(window, len(v))
        wins = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                named.add("" if item is None else str(item))
    return len(w), len(hit), sorted(named)


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = {k for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [line for line in text.split("\n") if words(line)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """``start, end, kind``, ordered as in the contract."""
    patterns = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
         lambda m: len(m[2]) >= 12),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16)]
    found = [(m.start(), k, m.end(), name) for k, (name, p, fits) in enumerate(patterns) for m in p.finditer(text or "") if fits(m)]
    return [(start, end, name) for start, _, end, name in sorted(found)]


def jump(key: int, shards: int) -> int:
    key, at, ahead = key % 2**64, -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % 2**64
        ahead = int((at + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return at


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2) -> dict:
    """Resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, open_ = share * sum(sizes.values()), {}, list(names)
    while open_:
        level = (total - sum(out.values())) / sum(weight[s] for s in open_)
        above = [s for s in open_ if weight[s] * level > cap * sizes[s]]
        if not above:
            return out | {s: weight[s] * level for s in open_}
        out |= {s: float(cap * sizes[s]) for s in above}
        open_ = [s for s in open_ if s not in above]
    return out


def branches(messages: list[tuple], best: int) -> dict:
    """The best paths by tree, from ``tree, id, parent, score``."""
    up = {(t, i): (None if p is None or (t, p) not in {(m[0], m[1]) for m in messages} else (t, p)) for t, i, p, _ in messages}
    score = {(t, i): s or 0.0 for t, i, _, s in messages}
    leaves = set(up) - {p for p in up.values() if p}
    found = defaultdict(list)
    for leaf in leaves:
        path, at = [], leaf
        while at and len(path) <= len(up):
            path.append(at)
            at = up[at]
        found[leaf[0]].append((-sum(score[n] for n in path), leaf[1], [n[1] for n in reversed(path)]))
    return {t: [p for _, _, p in sorted(v)[:best]] for t, v in found.items()}


def bucket_list(text: str | None, count: int) -> list[int]:
    """Buckets of words and word pairs, by the seeded hash that Spark's ``xxhash64`` documents."""
    w = [x.encode() for x in words(text)]
    firsts = [xxhash.xxh64_intdigest(x, seed=42) for x in w]
    hashes = firsts + [xxhash.xxh64_intdigest(b, seed=a) for a, b in zip(firsts, w[1:])]
    return [(h - (1 << 64) if h >> 63 else h) % count for h in hashes]


def log_ratios(rows: list[tuple[int | None, str | None]], trusted: set[int], count: int, smoothing: float) -> list[tuple[int, float | None]]:
    """Words and mean log ratio of each row; a trusted one is left out of the counts it is compared with."""
    grams = [Counter(bucket_list(text, count)) for _, text in rows]
    raw, good = sum(grams, Counter()), sum((g for (i, _), g in zip(rows, grams) if i in trusted), Counter())
    out = []
    for (i, text), g in zip(rows, grams):
        own = g if i in trusted else Counter()
        r, t = raw.total() - own.total(), good.total() - own.total()
        each = sum(n * math.log((good[b] - own[b] + smoothing) / ((raw[b] - own[b]) * (t / r) + smoothing)) for b, n in g.items()) if t else 0.0
        out.append((len(words(text)), each / g.total() if g else None))
    return out
