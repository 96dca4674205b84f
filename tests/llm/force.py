"""Plain Python versions of operators, for small tables."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

from .helpers import WORD

MASK = (1 << 64) - 1


def mixed(h: int) -> int:
    h = ((h ^ (h >> 33)) * 0xFF51AFD7ED558CCD) & MASK
    h = ((h ^ (h >> 33)) * 0xC4CEB9FE1A85EC53) & MASK
    return h ^ (h >> 33)


def word_hash(word: bytes) -> int:
    h, power = 0, 1
    for b in word:
        h = (h + (b + 1) * power) & MASK
        power = (power * 0x9E3779B97F4A7C15) & MASK
    return mixed((h + len(word) * 0xD6E8FEB86659FD93) & MASK)


def language_vector(text: str, dimensions: int = 4096) -> list[float]:
    """Square roots of the counts of hashed trigrams and words, of length 1."""
    form = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
    counts = [0.0] * dimensions
    for a, b, c in zip(form, form[1:], form[2:]):  # noqa: B905
        if b == 32 and (a == 32 or c == 32):
            continue
        h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & 0xFFFFFFFF
        counts[(((h ^ (h >> 15)) * 0x27D4EB2F) & 0xFFFFFFFF) >> 20] += 1
    for word in form.split():
        counts[word_hash(word) >> 52] += 1
    roots = [math.sqrt(c) for c in counts]
    norm = math.sqrt(sum(r * r for r in roots))
    return [r / norm for r in roots] if norm else roots


def duel(duels, v: list[float], bias: float) -> tuple[str, float]:
    if len(duels.labels) == 1:
        return duels.labels[0], 1.0
    wins, least = Counter(), {name: 1.0 for name in duels.labels}
    for (a, b), weights in zip(duels.pairs, duels.weights, strict=True):
        margin = sum(x * w for x, w in zip(v, weights) if x) + bias * weights[-1]  # noqa: B905
        sure = 1 / (1 + math.exp(-3 * max(-20, min(20, margin))))
        for name, p in ((duels.labels[a], sure), (duels.labels[b], 1 - sure)):
            least[name] = min(least[name], p)
        wins[duels.labels[a] if sure >= 0.5 else duels.labels[b]] += 1
    best = max(duels.labels, key=lambda name: (wins[name], least[name]))
    return best, least[best]


def language(model, text: str | None, bias: float = 0.3) -> tuple[str, float]:
    if text is None or not any(c.isalpha() for c in text) or model.families is None:
        return "und", 0.0
    v = language_vector(text)
    family, a = duel(model.families, v, bias)
    name, b = duel(model.languages[family], v, bias)
    return name, a * b


def components(rows, k: int, percent: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (size of its set, least id that it reaches by links)."""
    sets = {}
    for i, text, *_ in rows:
        if i is None:
            continue
        w = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(sets[i]), root(i)) for i in ids}


def without_repeats(rows, least: int = 50) -> dict[int, tuple[str | None, int]]:
    """doc_id -> (text without later copies of runs of lines, lines deleted), for texts without blank lines."""
    lines = {i: (t or "").split("\n") for i, t, *_ in rows}
    first: dict[tuple[str, ...], tuple[int, int]] = {}
    runs = []
    for i in sorted(lines):
        for a in range(len(lines[i])):
            words = 0
            for b in range(a, len(lines[i])):
                words += len(WORD.findall(lines[i][b]))
                if words >= least:
                    run = tuple(lines[i][a : b + 1])
                    first.setdefault(run, (i, a))
                    runs.append((i, a, b, run))
    gone = defaultdict(set)
    for i, a, b, run in runs:
        d, at = first[run]
        if (d, at) != (i, a):
            gone[i].update(range(max(a, at + b - a + 1) if d == i else a, b + 1))
    texts = {i: t for i, t, *_ in rows}
    return {i: (None if texts[i] is None else "\n".join(x for j, x in enumerate(lines[i]) if j not in gone[i]), len(gone[i])) for i in lines}


def mixture(rows, weights=(3, 1, 2), share: float = 1.5, most: int = 2) -> dict[int, int]:
    """doc_id -> times taken, of rows (doc_id, text, lang, source)."""
    sizes = {i: len(WORD.findall(t or "")) for i, t, *_ in rows}
    of = defaultdict(list)
    for i, _, _, source in rows:
        of[source].append(i)
    sources = sorted(of, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(sizes[i] for i in of[s]) for s in sources}
    weight = {s: weights[n % len(weights)] for n, s in enumerate(sources)}
    target, open_, budget = {}, set(sources), share * sum(total.values())
    while open_:
        level = budget / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level >= most * total[s]]
        for s in over or list(open_):
            target[s] = most * total[s] if over else weight[s] * level
            budget -= target[s] if over else 0
            open_.discard(s)
    taken = {}
    for s in sources:
        copies = int(target[s] // total[s]) if total[s] else 0
        rest, upto = target[s] - copies * total[s], 0
        by_hash = defaultdict(list)
        for i in of[s]:
            by_hash[int(hashlib.md5(str(i).encode()).hexdigest()[:12], 16)].append(i)
        past = False
        for h in sorted(by_hash):
            own = sum(sizes[i] for i in by_hash[h])
            more = 0
            if not past:
                past = upto + own > rest
                more = int(not past or upto + own - rest < rest - upto)
                upto += own
            for i in by_hash[h]:
                taken[i] = copies + more
    return taken
