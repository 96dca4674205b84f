"""Clustering, conversation repair and MinHash near-dedup on awkward rows and against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import cache
from itertools import product

import numpy as np
import pytest

from folioquarry.llm import op11_clustering, op12_conversations, op13_minhash
from folioquarry.llm.queries import QUERIES

from . import force
from .helpers import awkward, clashing, documents

VECTORS = "vec_id long, embedding array<float>, label int"


def clusters_by_force(rows, k, rounds, dims, scale=64):
    """vec_id -> (cluster, distance), of unique ids, and the final centroids."""
    floor = lambda x: int(np.floor(np.float64(np.float32(x)) * scale))
    kept = {i: [floor(x) for x in v] for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(np.float32(x)) for x in v)}
    order = sorted(kept, key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())
    centroids = [list(kept[i]) for i in order[:k]]
    distance = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    nearest = lambda v: min(range(len(centroids)), key=lambda j: (distance(v, centroids[j]), j))
    for _ in range(rounds):
        of = {i: nearest(v) for i, v in kept.items()}
        for j in range(len(centroids)):
            own = [kept[i] for i in kept if of[i] == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return {i: (j := nearest(v), distance(v, centroids[j])) for i, v in kept.items()}, centroids


@pytest.mark.parametrize("seed,k,rounds,spread", [(1, 5, 3, 2.0), (2, 16, 3, 0.02), (3, 3, 0, 1.0), (4, 40, 2, 0.03), (5, 1, 3, 1.0)])
def test_clusters_by_force(spark, seed, k, rounds, spread):
    """Ties in plenty (few distinct integers), repeated vectors, ones that do not count; more clusters than vectors differ."""
    r = random.Random(seed)
    rows = [(i, [r.gauss(i % 3, spread) / 2 for _ in range(4)]) for i in range(300)]
    rows += [(1000 + i, [0.25, -0.25, 0.0, 0.5]) for i in range(150)]  # one vector of a third of the rows
    rows += [(2000, None), (2001, []), (2002, [1.0] * 3), (2003, [1.0, None, 0.0, 0.0]), (2004, [float("nan"), 0, 0, 0]), (2005, [float("inf"), 0, 0, 0]), (2006, [-0.001, 0, 0, 0])]
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], VECTORS).repartition(3)
    out = op11_clustering.cluster_vectors(df, dims=4, k=k, rounds=rounds).collect()
    wanted, centroids = clusters_by_force(rows, k, rounds, 4)
    assert {x.vec_id: (x.cluster, x.distance) for x in out} == wanted
    inertia = Counter()
    for j, d in wanted.values():
        inertia[j] += d
    assert all(x.cluster_inertia == inertia[x.cluster] and x.inertia == sum(inertia.values()) and x.centroid == centroids[x.cluster] for x in out)


def test_bounds_skip_distances_and_change_nothing():
    """Well-parted clusters: after the first round few distances are measured, and assignments equal those of measuring all."""
    r = np.random.default_rng(5)
    x = (r.normal(0, 3, (2000, 8)) + r.integers(0, 12, 2000)[:, None] * 200).astype(np.int64)
    centroids = x[:12].copy()
    cluster, upper, lower = np.zeros(2000, dtype=np.int32), np.full(2000, np.inf), np.zeros((2000, 12))
    measured = []
    for _ in range(4):
        exact, n = op11_clustering.Bounds(centroids).assign(x, cluster, upper, lower, False)
        measured.append(n)
        every = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (every.argmin(axis=1) == cluster).all() and (every[np.arange(2000), cluster] <= upper**2 * (1 + 1e-9)).all() and (lower**2 <= every * (1 + 1e-9) + 1e-9).all()
        after = np.array([x[cluster == j].sum(axis=0) // max(1, (cluster == j).sum()) if (cluster == j).any() else centroids[j] for j in range(12)])
        shift = op11_clustering.above(((after - centroids) ** 2).sum(axis=1))
        upper, lower, centroids = upper + shift[cluster], np.maximum(lower - shift, 0), after
    assert measured[-1] < measured[0] / 4


def test_clusters_of_awkward_vectors(spark):
    """Null and repeated ids, ids of text, huge components, extra columns, no rows."""
    rows = [(None, [1.0] * 64, 0), (1, [0.0] * 64, 0), (1, [0.0] * 64, 0), (1, [3.0] * 64, 1), (2, [3.0e38] * 64, 1), (3, [-3.0e38] * 64, 1), (4, None, None)]
    df = spark.createDataFrame(rows, VECTORS)
    out = op11_clustering.clustered_rows(df)
    got = sorted(map(str, out.collect()))
    assert len(got) == 6 and all("distance=0" in x for x in got)  # as many clusters as vectors, so that none is far from its own
    for c in ("cluster", "distance", "x", "upper", "members", "centroid"):
        df = df.withColumn(c, df.label)
    assert sorted(map(str, op11_clustering.clustered_rows(df).collect())) == got
    text = op11_clustering.clustered_rows(df.withColumn("vec_id", df.vec_id.cast("string")))
    assert dict(text.dtypes)["vec_id"] == "string" and text.count() == 6
    none = op11_clustering.clustered_rows(df.where("false"))
    assert none.columns == out.columns and none.count() == 0
    two = op11_clustering.cluster_vectors(spark.createDataFrame([(i, [s * 3.0e38] * 64, 0) for i, s in enumerate([1, 1, -1])], VECTORS), k=1).collect()
    assert all(x.inertia == min(op11_clustering.LONGEST, sum(y.distance for y in two)) > 0 for x in two)


CONVERSATIONS = "conv_id long, turn long, role string, text string"
BLANK = re.compile("[^\x20\x09-\x0d]")
LEGAL = re.compile("(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def faults_of(turns):
    found, seen = [], set()
    for _, _, role, text in turns:
        last = [c for c in text if BLANK.match(c)][-1:]
        found.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else None)
        seen.add((role, text))
    return found


def cheapest(turns, faults):
    """(cost, audit, repaired) from the right: the least first edit, then the least rest."""

    @cache
    def rest(i, state, inserted):
        options = [(0, "", ())] if i == len(turns) and state in ("", "a") else []

        def add(cost, letter, after, out, nxt, k):
            if after is not None:
                c, a, r = rest(nxt, after, k)
                options.append((cost + c, letter + a, out + r))

        step = lambda initial: {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))
        if inserted < 3:
            for name in ("user", "assistant"):
                add(3, "I", step(name[0]), ((name, ""),), i, inserted + 1)
        if i < len(turns):
            _, _, role, text = turns[i]
            add(4, "D", state, (), i + 1, 0)
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] else 0
                add(more, "K", step(role[:1]), ((role, text),), i + 1, 0)
                for name in ("user", "assistant"):
                    add(more + 3, "R", step(name[0]), ((name, text),), i + 1, 0)
        return min(options) if options else (10**9, "", ())

    return rest(0, "", 0)


def repaired_by_force(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults = faults_of(turns)
        numbers = {t[1] for t in turns if t[1] is not None}
        cost, audit, repaired = cheapest(tuple(turns), tuple(faults))
        initials = [t[2][:1] for t in turns]
        text = "\n".join(f"{role}:{text}" for role, text in repaired)
        assert LEGAL.fullmatch("".join(role[0] for role, _ in repaired))
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest(),  # noqa: B905
        )
    return out


def conversations(seed, n):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "unknown", "User"]
    texts = ["Hello.", "Why?", "no end", "", " \t", None, "Yes!  ", "é.", "a\nb.", "Hello.", "x" * 3000 + "."]
    rows = []
    for conv in [*range(n), None]:
        for _ in range(r.choice([0, 1, 2, 3, 5, 8, 12])):
            rows.append((conv, r.choice([None, *range(10)]), r.choice(roles), r.choice(texts)))
    return rows


@pytest.mark.parametrize("seed,segment", [(1, 256), (2, 3), (3, 1)])
def test_conversations_by_force(spark, monkeypatch, seed, segment):
    """Every fault and edit, ties of turns and of edits, null everything; whatever the length of segments."""
    monkeypatch.setattr(op12_conversations, "SEGMENT", segment)
    rows = conversations(seed, 150)
    out = op12_conversations.repaired_rows(spark.createDataFrame(rows, CONVERSATIONS).repartition(3))
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert {x.conv_id: tuple(x[c] for c in columns) for x in out.collect()} == repaired_by_force(rows)
    assert out.count() == len({r[0] for r in rows})


def test_cheapest_edits_by_enumeration():
    """The brute-force version itself, against all edits of conversations of two turns."""
    kinds = [(role, fault) for role in ("user", "assistant", "system", "x") for fault in (None, "blank", "truncated")]
    gaps = ["", "I", "II"]
    for pair in product(kinds, repeat=2):
        turns = tuple((1, i, role, "t") for i, (role, _) in enumerate(pair))
        best = []
        for edits in product("DKR", repeat=2):
            for before in product(gaps, repeat=3):
                letters = before[0] + edits[0] + before[1] + edits[1] + before[2]
                places = [pair[0], pair[1]]
                choices, cost = [], 0
                at = 0
                for x in letters:
                    if x == "I":
                        choices.append("ua")
                        cost += 3
                        continue
                    role, fault = places[at]
                    at += 1
                    if x == "D":
                        cost += 4
                        continue
                    cost += 10**6 if fault == "blank" else (3 if fault else 0) + (3 if x == "R" else 0)
                    choices.append("ua" if x == "R" else role[0])
                if any(LEGAL.fullmatch("".join(c)) for c in product(*choices)):
                    best.append((cost, letters))
        assert cheapest(turns, tuple(f for _, f in pair))[:2] == min(best)


def test_long_and_odd_conversations(spark):
    """Thousands of turns in one conversation, extreme turns, extra columns, and no rows."""
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(3000)] + [(2, -(1 << 63), "user", "a."), (2, (1 << 63) - 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    out = {x.conv_id: x for x in op12_conversations.repaired_rows(df).collect()}
    wanted = repaired_by_force([r for r in rows if r[0] == 1 and r[1] < 60])
    some = op12_conversations.repaired_rows(df.where("conv_id = 1 AND turn < 60")).first()
    assert (some.cost, some.audit, some.repaired_sha256) == (wanted[1][5], wanted[1][6], wanted[1][7])
    assert out[1].cost > 0 and len(out[1].audit) >= len(damaged([r for r in rows if r[0] == 1])) and out[2].gaps == op12_conversations.LONGEST
    extra = df
    for c in ("dropped", "position", "fault", "initial", "segment", "edits", "walks"):
        extra = extra.withColumn(c, df.role)
    again = {x.conv_id: x for x in op12_conversations.repaired_rows(extra).collect()}
    assert again == out
    assert op12_conversations.repaired_rows(df.where("false")).count() == 0
    turns = op12_conversations.repair(df.where("conv_id = 1 AND turn < 4")).first().turns
    assert [(t.role, t.text) for t in turns] == [(r[2], r[3]) for r in rows[:4]]


def near_rows(seed):
    """Chains, sparse groups and copies: few of a group link to its hub, and some only to members that do not."""
    r = random.Random(seed)
    rows = [(i, t, None, None) for i, (d, t, *_) in enumerate(awkward()) if d is not None and len(t or "") < 10_000]
    for base in range(5):
        words = [f"w{base}x{r.randint(0, 500)}" for _ in range(r.choice([9, 40, 120]))]
        for _ in range(40):
            own = list(words)
            for _ in range(r.randint(0, len(words) // 12 + 1)):
                own[r.randrange(len(own))] = f"e{r.randint(0, 9)}"
            rows.append((len(rows) + 10, " ".join(own), None, None))
    chain = [f"c{i}" for i in range(300)]
    rows += [(len(rows) + 10 + s, " ".join(chain[: 300 - 9 * s]), None, None) for s in range(20)]
    rows += [(i + 1000, t, None, None) for i, t, *_ in rows[::7]]
    return rows


@pytest.mark.parametrize("seed,stars,hubs,tasks", [(1, 8, 4096, 2000), (2, 1, 1, 3), (3, 2, 4, 5)])
def test_near_duplicates_by_force(spark, monkeypatch, seed, stars, hubs, tasks):
    monkeypatch.setattr(op13_minhash, "STARS", stars)
    monkeypatch.setattr(op13_minhash, "HUBS", hubs)
    monkeypatch.setattr(op13_minhash, "GROWTH", 2)
    monkeypatch.setattr(op13_minhash, "ASKERS", tasks)
    monkeypatch.setattr(op13_minhash, "PARTNERS", tasks)
    rows = near_rows(seed)
    out = op13_minhash.near_duplicates(documents(spark, rows).repartition(3), 4, 80).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out} == force.components(rows, 4, 80)
    assert all(x.kept == (x.doc_id == x.component_id) for x in out) and len(out) == len(rows)


def test_near_duplicates_of_awkward_rows(spark):
    docs = documents(spark, awkward())
    out = op13_minhash.near_duplicates(docs)
    got = Counter(map(str, out.collect()))
    assert sum(got.values()) == len(awkward()) and {x.kept for x in out.where("doc_id IS NULL").collect()} == {True}
    assert {x.component_id for x in out.where("doc_id IN (4, 9)").collect()} == {4}
    assert Counter(map(str, op13_minhash.near_duplicates(clashing(docs)).collect())) == got
    assert op13_minhash.near_duplicates(docs.where("false")).count() == 0
    assert QUERIES["op13_minhash_dedup"].__name__ == "op13_minhash_dedup"


def test_sketches_keep_every_link():
    """Sets that just link: a shared bucket, sketches that leave the pair open, and odd sketches that never err."""
    r = np.random.default_rng(3)
    for n in (5, 9, 18, 45, 147, 1000):
        for t in range(60):
            extra = n // 9 if t % 2 else 0
            every = r.integers(0, 2**64, n + extra, dtype=np.uint64)
            a, b = np.sort(every[:n]), np.sort(every[extra:] if t % 2 else every[n // 5 :])
            common = len(np.intersect1d(a, b))
            assert 100 * common >= 80 * (len(a) + len(b) - common)
            row = lambda s: np.frombuffer(op13_minhash.mix(op13_minhash.sketch(s)).astype(np.uint8).tobytes() + op13_minhash.odd_sketch(s).tobytes(), np.uint8)
            assert (op13_minhash.buckets(op13_minhash.sketch(a)) == op13_minhash.buckets(op13_minhash.sketch(b))).any()
            assert op13_minhash.open_pairs(row(a), row(b), np.int64(len(a)), np.int64(len(b)), 80)
