"""The ten operators on awkward rows and against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from folioquarry.llm import common, op01_language, op02_jaccard, op03_secrets, op04_simhash, op05_sentencepiece, op06_mixing, op07_licenses, op08_sharding, op09_quality, op10_line_dedup
from folioquarry.llm.components import components
from folioquarry.llm.oracles import ORACLE_SQL
from folioquarry.llm.queries import QUERIES

from ..compare import against_sql
from . import force
from .helpers import WORD, awkward, clashing, documents

OPERATORS = {
    "op1": op01_language.language_rows, "op2": op02_jaccard.jaccard_components, "op3": op03_secrets.secret_rows, "op4": op04_simhash.edited_fingerprints,
    "op5": op05_sentencepiece.piece_rows, "op6": op06_mixing.mix_plan, "op7": op07_licenses.scan_licenses, "op8": lambda d: op08_sharding.assign_shards(d, "doc_id"),
    "op9": op09_quality.clean, "op10": op10_line_dedup.dedup_lines,
}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    ours, theirs = against_sql(QUERIES[name](spark, sf_dir), ORACLE_SQL[name], sf_dir)
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward_rows(spark, name):
    """One row out per row in; extra columns change nothing; an empty table gives none."""
    docs = documents(spark, awkward())
    out = OPERATORS[name](docs)
    ids = Counter(r["doc_id"] for r in out.collect())
    expected = Counter(r[0] for r in awkward())
    assert ids == expected
    same = lambda df: sorted(map(str, df.select(*[c for c in out.columns if c in df.columns]).collect()))
    picked = [c for c in out.columns if c not in docs.columns or c in ("doc_id", "text")]
    assert same(out.select(*picked)) == same(OPERATORS[name](clashing(docs)).select(*picked))
    assert OPERATORS[name](docs.where("false")).count() == 0


def test_language_held_out_accuracy(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    out = op01_language.language_rows(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = out.select(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right / n >= 0.9
    assert out.where("score < 0 or score > 1").isEmpty()


def test_language_by_force(spark, sf_dir):
    """Every prediction from the fitted machines, by plain Python: the family first, then the language in it."""
    docs = common.documents(spark, sf_dir)
    model = op01_language.learn(docs)
    assert len(model.languages) > 1 and any(len(d.labels) > 1 for d in model.languages.values())
    rows = op01_language.identify(docs, model).select("text", "lang_pred", "score").collect()
    rows += op01_language.identify(documents(spark, awkward()), model).select("text", "lang_pred", "score").collect()
    for r in rows:
        name, score = force.language(model, r.text)
        assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-9)


def test_languages_within_a_family(spark):
    """A label of a family is only chosen among its own, ties and the empty label included; of too many labels the largest are learned."""
    words = {"en": "the and of house water", "de": "der und von haus wasser", "fr": "le et de maison eau", "": "zz qq xx zq xq"}
    rows = [(i, f"{words[lang]} {i % 7} {words[lang].split()[i % 5]}", lang, None) for i, lang in enumerate(list(words) * 30)]
    docs = documents(spark, rows)
    model = op01_language.learn(docs)
    assert sorted(model.languages) == ["", "germanic", "romance"] and model.languages["germanic"].labels == ["de", "en"]
    assert all(r.lang_pred == r.lang for r in op01_language.identify(docs, model).collect())
    few = op01_language.learn(docs, most_labels=3)
    assert sorted(n for d in few.languages.values() for n in d.labels) == ["", "de", "en"]  # of equally many texts, the first by code point


def test_two_hundred_labels(spark):
    """Many labels, none of a known family, are learned in groups of like ones; the texts of all together are bounded."""
    r = random.Random(4)
    rows = [(i, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{r.choice('pqrst')}" for _ in range(30)), f"x{k:03}", None) for i, k in enumerate(list(range(200)) * 9)]
    model = op01_language.learn(documents(spark, rows))
    sizes = [len(d.labels) for d in model.languages.values()]
    assert sum(sizes) == 200 and 10 <= len(sizes) <= 18
    sample = documents(spark, rows[::31])
    out = op01_language.identify(sample, model)
    assert out.where("lang = lang_pred").count() >= 0.9 * out.count()


def test_language_undetermined_and_untaught(spark):
    docs = documents(spark, awkward())
    out = {r.doc_id: r for r in op01_language.language_rows(docs).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (1, 2, 3, 6))
    none = op01_language.language_rows(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard_by_force(spark, monkeypatch, k, percent):
    monkeypatch.setattr(op02_jaccard, "BLOCK", 4)
    r = random.Random(9)
    rows = [(i, t, None, None) for i, (d, t, *_) in enumerate(awkward()) if d is not None and len(t or "") < 10_000]
    for base in range(4):
        words = [f"w{base}x{r.randint(0, 500)}" for _ in range(120)]
        for _ in range(30):
            own = list(words)
            for _ in range(r.randint(0, 5)):
                own[r.randrange(len(own))] = f"e{r.randint(0, 9)}"
            rows.append((len(rows) + 10, " ".join(own), None, None))
    chain = [f"c{i}" for i in range(200)]
    for step in range(15):  # each like the next, the ends unlike
        rows.append((len(rows) + 10, " ".join(chain[: 200 - 4 * step]), None, None))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in op02_jaccard.jaccard_components(documents(spark, rows).repartition(3), k, percent).collect()}
    assert got == force.components(rows, k, percent)


def test_jaccard_of_sparse_groups_by_force(spark, monkeypatch):
    """Texts that all share a part, few of which link, in blocks of one: components grow between the rounds."""
    monkeypatch.setattr(op02_jaccard, "BLOCK", 1)
    r = random.Random(5)
    top = lambda w: op02_jaccard.shingle_set(np.frombuffer(w.encode(), np.uint8), 1)[0] >> np.uint64(61) == 7
    rows = []
    for base in range(3):
        fixed = [w for w in (f"f{base}x{i}" for i in range(100)) if not top(w)][:24]
        varied = [w for w in (f"v{base}x{i}" for i in range(1000)) if top(w)][:24]
        chosen = {tuple(r.randrange(4) for _ in range(6)) for _ in range(200)}
        for pick in sorted(chosen):  # texts link that differ in one of the six words
            rows.append((0, " ".join(fixed + [varied[4 * at + w] for at, w in enumerate(pick)]), None, None))
    ids = r.sample(range(10_000), len(rows))
    rows = [(i, *row[1:]) for i, row in zip(ids, rows, strict=True)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in op02_jaccard.jaccard_components(documents(spark, rows), 1, 90).collect()}
    assert got == force.components(rows, 1, 90)


def test_components_of_a_path(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (100, 102), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100, 102: 100}
    assert components(edges.where("false")).count() == 0


def test_secrets_spans_and_ledger(spark):
    token = "a1b2c3d4" * 4
    text = f"é password = 'hunter22' AKIA{'Q' * 16} secret=token:abcdefgh TOKEN: short {token}"
    versions = spark.createDataFrame([("p1", text), ("p2", text), ("p3", "clean"), ("p4", None)], "path string, text string")
    found, ledger = op03_secrets.scan(versions)
    spans = {r.path: [(s.kind, s.start, s.end) for s in r.spans or []] for r in found.collect()}
    assert spans["p1"] == spans["p2"] and spans["p3"] == spans["p4"] == []
    assert [k for k, *_ in spans["p1"]] == ["assign", "access", "hex"]
    for kind, start, end in spans["p1"]:
        assert text[start:end].startswith({"assign": "password", "access": "AKIA", "hex": "a1b2"}[kind])
    ledger = common.written(ledger)
    assert ledger.count() == 3
    again, grown = op03_secrets.scan(spark.createDataFrame([("new", text), ("other", f"x {token}")], "path string, text string"), ledger)
    assert grown.count() == 4
    assert {r.path: len(r.spans) for r in again.collect()} == {"new": 3, "other": 1}
    _, other_rules = op03_secrets.scan(versions, ledger, version="2")
    assert other_rules.count() == 6


def test_secrets_history_scans_unseen_pairs_only(spark, monkeypatch):
    """Commits with common blobs, and a ledger: each pair of blob and rules version is scanned once, paths get all findings."""
    scanned = []
    original = op03_secrets.scan_blobs

    def spied(blobs, rules):
        scanned.append(sorted(r["text"] for r in blobs.collect()))
        return original(blobs, rules)

    monkeypatch.setattr(op03_secrets, "scan_blobs", spied)
    commit = lambda *rows: spark.createDataFrame(rows, "path string, text string")
    a, b, c = "password: aaaaaa1", "token=bbbbbbb2", "clean"
    history = [commit(("p", a), ("q", c), ("r", a)), commit(("p", b), ("s", a), ("q", c)), commit(("t", b), ("u", None))]
    found, ledger = op03_secrets.scan_history(history)
    assert scanned == [sorted([a, c]), [b], [""]]
    assert sorted((r.path, r.spans is not None) for r in found.collect()) == sorted([("p", True), ("q", False), ("r", True), ("p", True), ("s", True), ("q", False), ("t", True), ("u", False)])
    assert ledger.count() == 4
    op03_secrets.scan_history(history[:2], ledger)
    assert scanned[3:] == [[], []]
    op03_secrets.scan_history(history[:2], ledger, version="2")
    assert scanned[5:] == [sorted([a, c]), [b]]


def test_secrets_of_long_runs(spark):
    """A run with very many beginnings of a token and no end is no work."""
    docs = documents(spark, [(1, "eyJ" * 200_000, None, None), (2, "password = " + "k" * 100_000, None, None)])
    got = {r.doc_id: r.spans for r in op03_secrets.secret_rows(docs).collect()}
    assert got == {1: "", 2: f"assign:0:{len('password = ') + 100_000}"}


def spark_xxhash(*parts: str) -> int:
    seed = 42
    for p in parts:
        if p is not None:
            seed = xxhash.xxh64_intdigest(p.encode(), seed=seed)
    return seed


def simhash_by_force(text: str) -> int:
    w = WORD.findall(text)
    terms = [tuple(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [tuple(w + [None] * (3 - len(w)))] if w else []
    hashes = [spark_xxhash(*t) for t in terms]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_by_force(spark, monkeypatch):
    monkeypatch.setattr(op04_simhash, "RANGE_BYTES", 200)
    r = random.Random(3)
    rows = [(i * 3, " ".join(r.choice("alpha beta gamma delta é".split()) for _ in range(r.randint(0, 40))), None, None) for i in range(40)]
    rows += [(500, "", None, None), (501, None, None, None), (502, "one", None, None)]
    texts = {i: t or "" for i, t, *_ in rows}
    order = sorted(texts, reverse=True)
    got = {x.doc_id: x for x in op04_simhash.edited_fingerprints(documents(spark, rows).repartition(3)).collect()}
    likeness = lambda a, b: (64 - bin(a ^ b).count("1")) / 64
    for at, i in enumerate(order):
        following = texts[order[(at + 1) % len(order)]]
        cut = len(texts[i]) // 3
        edited = texts[i][: len(texts[i]) - cut] + following[:cut]
        own, other, nxt = simhash_by_force(texts[i]), simhash_by_force(edited), simhash_by_force(following)
        x = got[i]
        assert (x.n_chars, x.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert (x.fingerprint, x.edited_fingerprint) == (format(own, "016x"), format(other, "016x"))
        assert (x.near_edited, x.near_next) == (likeness(own, other), likeness(own, nxt))
        near = sum(1 for j in texts if j != i and likeness(own, simhash_by_force(texts[j])) >= 61 / 64)
        assert x.n_near == (near if i % 100 == 0 else None)


def test_simhash_of_repeated_words(spark):
    """All terms of full runs vote alike, also for the highest lane."""
    texts = {1: "same " * 40_000, 2: "one two three " * 20_000, 3: "a b " * (1 << 14) + "a b c", 4: "w " * ((1 << 15) + 2)}
    got = op04_simhash.fingerprints(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), ["doc_id"], "text", "fp").collect()
    assert {r.doc_id: r.fp % (1 << 64) for r in got} == {i: simhash_by_force(t) for i, t in texts.items()}


def test_near_fingerprints_by_force(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(20)]
    prints = {b for b in base}
    for b in base:
        for _ in range(6):
            for bit in r.sample(range(64), r.randint(0, 6)):
                b ^= 1 << bit
            prints.add(b)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(p),) for p in prints] + [(None,)], "fp long")
    got = {(x.a, x.b, x.distance) for x in op04_simhash.near_pairs(df).collect()}
    every = sorted(map(signed, prints))
    mask = (1 << 64) - 1
    assert got == {(a, b, bin((a ^ b) & mask).count("1")) for a in every for b in every if a < b and bin((a ^ b) & mask).count("1") <= 3}


def test_secondary_operators_on_awkward_rows(spark, tmp_path):
    """What the queries do not run: repeats, nulls, empty tables and further columns with names of working ones."""
    docs = documents(spark, awkward())
    for operator in (op06_mixing.mix, op02_jaccard.first_of_components, lambda d: op05_sentencepiece.decode(op05_sentencepiece.encode(d))):
        out = operator(docs)
        assert {r.doc_id for r in out.select("doc_id").collect()} <= {r[0] for r in awkward()}
        more = operator(clashing(docs))
        names = [c for c in clashing(docs).columns if c != "ids"]
        assert set(names) <= set(more.columns) and more.where("size <> 'mine' or rank <> 'mine' or n <> 'mine' or text_hash <> 'mine' or row <> 'mine'").isEmpty()
        key = lambda df: sorted((str(r.doc_id), str(r.text)) for r in df.select("doc_id", "text").collect())
        assert key(more) == key(out)
        assert operator(docs.where("false")).isEmpty()
    kept = op02_jaccard.first_of_components(docs).select("doc_id").collect()
    assert Counter(r.doc_id for r in kept) == Counter({None: 1, 1: 1, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1, 7: 1, 8: 1})
    op08_sharding.write_shards(clashing(docs), "doc_id", str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == docs.count()


def test_encoding_equals_the_library(spark, monkeypatch):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=op05_sentencepiece.MODEL_PATH)
    r = random.Random(4)
    rows = [*awkward(), (20, "".join(r.choice("abcdefghé") for _ in range(900)), None, None), (21, "  two  spaces \n\n line ", None, None)]
    for giant in (60_000, 97):  # whole texts, and chunks with borders inside words
        out = op05_sentencepiece.encode(documents(spark, rows).select("doc_id", "text"), **{"giant": giant})
        texts = {r.doc_id: (r.text, r.ids) for r in out.collect()}
        for text, ids in texts.values():
            assert ids == (None if text is None else sp.encode(text))
        back = {r.doc_id: r.text for r in op05_sentencepiece.decode(out).collect()}
        assert back == {k: t for k, (t, _) in texts.items()}


def test_matrices_are_associative():
    r = np.random.default_rng(2)
    a, b, c = (np.where(r.random(shape) < 0.4, -np.inf, r.integers(-9, 1, shape)) for shape in ((3, 4), (4, 5), (5, 2)))
    f = op05_sentencepiece.compose
    assert (f(f(a, b), c) == f(a, f(b, c))).all()
    force = [[max(a[i][k] + b[k][j] for k in range(4)) for j in range(5)] for i in range(3)]
    assert f(a, b).tolist() == force


def test_every_giant_goes_through_the_scan(spark, monkeypatch):
    """Chunks of 40 characters, products of two: every text above that has a matrix a chunk, in a tree; ids are the library's."""
    import sentencepiece

    monkeypatch.setattr(op05_sentencepiece, "FAN", 2)
    seen: list[tuple[int, int]] = []
    scan = op05_sentencepiece.border_states

    def spied(chunks, model):
        out = scan(chunks, model, fan=2)
        seen.extend((r["row"], r["n"]) for r in out.groupBy("row").agg(F.count("*").alias("n")).collect())
        return out

    monkeypatch.setattr(op05_sentencepiece, "border_states", spied)
    sp = sentencepiece.SentencePieceProcessor(model_file=op05_sentencepiece.MODEL_PATH)
    r = random.Random(14)
    words = "The internationalisation of characteristic representations   is    extraordinarily \n straightforward é 日本 \U0001f600 aaaaaaaaaaaaa".split(" ")
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 90))) for _ in range(30)] + ["x" * 200, "in" * 150, " " * 130, "日" * 90, None, ""]
    out = op05_sentencepiece.encode(documents(spark, [(i, t, None, None) for i, t in enumerate(texts)]).select("doc_id", "text"), giant=40)
    got = {x.doc_id: x.ids for x in out.collect()}
    assert got == {i: None if t is None else sp.encode(t) for i, t in enumerate(texts)}
    chunks = sorted(-(-(len(t) + 1) // 40) for t in texts if t and len(t) > 40)
    assert sorted(n for _, n in seen) == chunks and chunks[-1] > 8
    with pytest.raises(ValueError):
        op05_sentencepiece.encode(documents(spark, []), giant=3)


def test_mixing_totals(spark):
    r = random.Random(6)
    rows = [(i, "w " * r.randint(0, 60), None, r.choice(["a", "b", "c", None, "d" if i % 2 else "a"])) for i in range(900)]
    rows.append((900, "w " * 5, None, "tiny"))
    out = op06_mixing.mix_plan(documents(spark, rows)).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for x in out:
        sizes[x.source] += x.size
        taken[x.source] += x.size * x.times
        target[x.source] = x.target
        assert 0 <= x.times <= 2
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in sizes:
        assert target[s] <= 2 * sizes[s] + 1e-9
        assert abs(taken[s] - target[s]) <= 60
    again = op06_mixing.mix_plan(documents(spark, rows[::-1]).repartition(5)).collect()
    assert {(x.doc_id, x.times) for x in out} == {(x.doc_id, x.times) for x in again}
    assert {x.doc_id: x.times for x in out} == force.mixture(rows)
    mixed = op06_mixing.mix(documents(spark, rows))
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {x.doc_id: x.times for x in out if x.times}


@pytest.mark.parametrize("shape", ["null ids", "one id", "equal rows"])
def test_mixing_of_shared_ids(spark, shape):
    """Sources whose rows share an id, or are equal, meet their targets to within a document, in the plan and in the mix; reruns agree."""
    r = random.Random(8)
    ids = {"null ids": lambda i: None if i % 10 else i, "one id": lambda i: 7, "equal rows": lambda i: None}[shape]
    text = lambda i: "w " * 20 if shape == "equal rows" and i % 9 else "w " * r.randint(1, 40)
    rows = [(ids(i), text(i), None, "ab"[i % 2]) for i in range(400)]
    docs = documents(spark, rows)
    out = op06_mixing.mix_plan(docs).collect()
    sizes, taken, mixed, target = Counter(), Counter(), Counter(), {}
    for x in out:
        sizes[x.source] += x.size
        taken[x.source] += x.size * x.times
        target[x.source] = x.target
    for x in op06_mixing.mix(docs).collect():
        mixed[x.source] += len(WORD.findall(x.text))
    assert len(out) == 400 and all(abs(taken[s] - target[s]) <= 40 and abs(mixed[s] - target[s]) <= 40 for s in sizes)
    again = op06_mixing.mix_plan(documents(spark, rows[::-1]).repartition(3)).collect()
    key = lambda x: (x.doc_id is None, x.doc_id, x.source, x.size, x.times)
    assert sorted(map(key, out), key=str) == sorted(map(key, again), key=str)


def test_mixing_budgets_are_nested(spark):
    docs = documents(spark, [(i, "w " * (i % 17 + 1), None, "ab"[i % 2]) for i in range(400)])
    few = {(r.doc_id, r.times) for r in op06_mixing.mix_plan(docs, share=0.5).collect()}
    many = dict(tuple(r) for r in op06_mixing.mix_plan(docs, share=0.9).select("doc_id", "times").collect())
    assert all(many[i] >= t for i, t in few)


def test_licenses(spark):
    mit = op07_licenses.TEXTS["MIT"]
    changed = "Copyright (c) 2020 Someone\n" + mit.upper().replace(",", " ;").replace("SUBLICENSE", "SUB-LICENSE").replace("NONINFRINGEMENT", "NON-INFRINGEMENT")
    rows = [(1, mit, None, None), (2, changed, None, None), (3, mit + " but not quite", None, None), (4, "text\n  licensed under the MIT licence \nmore", None, None), (5, None, None, None)]
    got = {r.doc_id: (r.license_id, r.notices) for r in op07_licenses.scan_licenses(documents(spark, rows)).collect()}
    assert got == {1: ("MIT", ""), 2: ("MIT", ""), 3: (None, ""), 4: (None, "MIT"), 5: (None, "")}


def test_whole_licenses(spark):
    """Every licence file, with a copyright line, without title, without line breaks; and an Apache licence with its owner."""
    texts = {f.stem: f.read_text(encoding="utf-8") for f in Path(op07_licenses.__file__).parent.glob("licenses/*.txt")} | {"MIT": op07_licenses.TEXTS["MIT"]}
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"} <= set(texts)
    forms = []
    for name, text in texts.items():
        untitled = "\n".join([x for x in text.split("\n") if x.strip()][op07_licenses.TITLE_LINES[name] :])
        forms += [(name, text), (name, "Copyright (c) 2020 Someone\n" + text.upper()), (name, untitled)]
    forms.append(("Apache-2.0", texts["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 Someone")))
    forms.append(("BSD-3-Clause", "Copyright 2020 Someone\nAll rights reserved.\n" + "\n".join(texts["BSD-3-Clause"].split("\n")[1:])))
    forms.append((None, texts["GPL-3.0"].replace("patent", "")))
    got = {r.doc_id: r.license_id for r in op07_licenses.scan_licenses(documents(spark, [(i, t, None, None) for i, (_, t) in enumerate(forms)])).collect()}
    assert [got[i] for i in range(len(forms))] == [name for name, _ in forms]


def test_shards_by_force(spark):
    shards, size = [f"s{i}" for i in range(7)], 101
    table = op08_sharding.fill_table(shards, size)
    counts = Counter(table)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    fewer = op08_sharding.fill_table(shards[:-1], size)
    moved = sum(1 for a, b in zip(table, fewer, strict=True) if a != 6 and a != b)
    assert moved <= size * 0.3
    keys = [(str(i),) for i in range(300)] + [(None,)]
    got = {r.k: (r.slot, r.shard) for r in op08_sharding.assign_shards(spark.createDataFrame(keys, "k string"), "k", shards, size).collect()}
    for k, (slot, shard) in got.items():
        assert slot == int(hashlib.md5((k or "").encode()).hexdigest()[:12], 16) % size and shard == shards[table[slot]]
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            op08_sharding.fill_table(bad, size)
    with pytest.raises(ValueError):
        op08_sharding.fill_table(shards, 100)


def test_shards_are_written(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i}", "mine") for i in range(50)], "k long, text string, slot string")
    op08_sharding.write_shards(rows, "k", str(tmp_path / "out"), [f"s{i}" for i in range(5)], 101)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == ["k", "shard", "text"]
    want = op08_sharding.assign_shards(rows, "k", [f"s{i}" for i in range(5)], 101).select("k", "text", "shard")
    assert sorted(map(tuple, back.select("k", "text", "shard").collect())) == sorted(map(tuple, want.collect()))


def test_shards_are_even(spark):
    counts = [r["count"] for r in op08_sharding.assign_shards(spark.range(64_000).toDF("k"), "k").groupBy("shard").count().collect()]
    assert len(counts) == 64 and max(counts) < 1.25 * 1000


def test_quality_removes_common_lines(spark):
    common_line = "this line is on every page of the host and says nothing " * 6
    letters = lambda i: "".join("abcdefghij"[int(d)] for d in str(i))
    own = lambda i: " ".join(f"own{letters(i)}x{letters(j)}" for j in range(90))
    rows = [(i, f"{common_line}\n{own(i) if i % 2 else f'short{letters(i)}'}", None, "h") for i in range(40)] + [(100 + i, own(100 + i), None, "other") for i in range(5)]
    rows += [(200 + i, f"{own(200 + i)}\n\n{common_line.upper()}!", None, "h") for i in range(3)]
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in op09_quality.clean(docs, repeat_percent=100).collect()}
    assert all(got[i].kept == bool(i % 2) and got[i].removed_words == 72 for i in range(40))
    assert all(got[i].text == (own(i) if i % 2 else f"short{letters(i)}") for i in range(40))
    assert all(got[100 + i].kept and not got[100 + i].removed_words and got[100 + i].text == own(100 + i) for i in range(5))
    assert all(got[200 + i].kept and got[200 + i].text == own(200 + i) + "\n" for i in range(3))
    out = {r.doc_id: r.clean_sha256 for r in op09_quality.quality_rows(docs).collect()}
    assert out == {i: hashlib.sha256(got[i].text.encode()).hexdigest() for i in got}


def test_quality_counts_documents_not_rows(spark):
    line = "a line of one document that came in very many rows of it"
    docs = documents(spark, [(7, f"{line}\nrow {chr(97 + i)}", None, "h") for i in range(20)] + [(100 + i, f"own text {chr(97 + i)}", None, "h") for i in range(5)])
    assert all(not r.removed_words and (r.text or "").startswith((line, "own")) for r in op09_quality.clean(docs).collect())
    assert all(r.removed_words for r in op09_quality.clean(docs.withColumn("doc_id", F.monotonically_increasing_id())).where(F.col("text").startswith("row") | F.col("text").startswith(line)).collect())


def test_lines_are_removed_across_blocks(monkeypatch):
    from folioquarry.llm import wordhash

    monkeypatch.setattr(wordhash, "BLOCK", 7)
    for text, less in (("a\nbb cc\nd", "a\nd"), ("bb cc\n", ""), ("bb cc", ""), ("x\n\nBB, CC", "x\n"), ("bb cc\nbb cc\nq\n", "q\n"), ("", "")):
        gone = op09_quality.text_facts(np.frombuffer(b"bb cc", np.uint8))[1]
        assert op09_quality.without_lines(np.frombuffer(text.encode(), np.uint8), gone).decode() == less


def lines_by_force(rows, least):
    """Every place of every run of lines with enough words; a line goes if some run that holds it came earlier."""
    seqs = []
    for at, (i, text, *_) in enumerate(sorted(rows, key=lambda r: r[0])):
        lines = (text or "").split("\n")
        seqs.append((i, lines, [j for j, x in enumerate(lines) if WORD.search(x)]))
    first = {}
    for d, (_, lines, solid) in enumerate(seqs):
        for a in range(len(solid)):
            words = 0
            for b in range(a, len(solid)):
                words += len(WORD.findall(lines[solid[b]]))
                if words >= least:
                    first.setdefault(tuple(lines[j] for j in solid[a : b + 1]), (d, a))
    out = {}
    for d, (i, lines, solid) in enumerate(seqs):
        gone = set()
        for a in range(len(solid)):
            words = 0
            for b in range(a, len(solid)):
                words += len(WORD.findall(lines[solid[b]]))
                if words >= least:
                    at = first[tuple(lines[j] for j in solid[a : b + 1])]
                    if at != (d, a):
                        begin = max(a, at[1] + b - a + 1) if at[0] == d else a
                        gone.update(range(begin, b + 1))
        out[i] = len(gone)
    return out


def test_line_dedup_by_force(spark):
    r = random.Random(8)
    pool = [" ".join(f"p{k}w{j}" for j in range(r.choice([3, 8, 20, 55]))) for k in range(12)]
    rows = []
    for i in range(60):
        lines = []
        while len(lines) < r.randint(1, 14):
            if r.random() < 0.6:
                at = r.randrange(len(pool))
                lines += pool[at : at + r.randint(1, 6)]
            else:
                lines.append(" ".join(f"u{i}{len(lines)}w{j}" for j in range(r.randint(0, 30))))
        rows.append((i, "\n".join(lines), None, None))
    rows.append((70, rows[3][1], None, None))
    got = {x.doc_id: x.removed_lines for x in op10_line_dedup.dedup_lines(documents(spark, rows).repartition(3)).collect()}
    assert got == lines_by_force(rows, op10_line_dedup.MIN_WORDS)


def test_line_dedup_leaves_the_first(spark):
    passage = " ".join(f"w{i}" for i in range(51))
    rows = [(2, f"a\n{passage}\nb", None, None), (1, f"{passage}\nc", None, None), (3, "short\nd", None, None), (4, "short\ne", None, None), (5, passage, None, None)]
    got = {x.doc_id: x.text for x in op10_line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert got == {1: f"{passage}\nc", 2: "a\nb", 3: "short\nd", 4: "short\ne", 5: ""}


def test_fit_is_bounded(spark, monkeypatch):
    seen = []
    original = op01_language.LanguageModel.fit.__func__
    monkeypatch.setattr(op01_language.LanguageModel, "fit", classmethod(lambda cls, x, y: seen.append(Counter(y)) or original(cls, x, y)))
    docs = documents(spark, [(i, f"text {i} of words", "en" if i % 3 else "de", "s") for i in range(3000)])
    op01_language.learn(docs, per_language=50)
    assert max(seen[0].values()) <= 50 and math.isfinite(sum(seen[0].values())) and set(seen[0]) == {"en", "de"}
    assert defaultdict(int, seen[0])["en"] > 20
