"""Many patterns, ranked pages and budgeted answers against plain Python."""

import datetime
import math
import random
import re
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from folioquarry.operators import answers, patterns, retrieval, search, spans


def corpus(seed: int, n: int) -> list[tuple[int, int, str | None]]:
    r = random.Random(seed)
    words = [f"w{int(r.paretovariate(0.6)) % 60}" for _ in range(4000)]
    rows = [(i // 3, i % 3, " ".join(r.choice(words) for _ in range(r.randint(1, 40)))) for i in range(n)]
    return [*rows, (900, 0, None), (901, 0, ""), (902, 0, "!!"), (903, 0, "W1 w1, É é")]


def best(pages, queries, k):
    terms = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    split = {(d, p): terms(t) for d, p, t in pages if terms(t)}
    mean, df = sum(map(len, split.values())) / len(split), Counter(x for t in split.values() for x in set(t))
    out = []
    for q, text in queries:
        scores = []
        for key, own in split.items():
            tf, s = Counter(own), 0.0
            for x in set(terms(text)) & set(own):
                s += math.log(1 + (len(split) - df[x] + 0.5) / (df[x] + 0.5)) * tf[x] * 2.2 / (tf[x] + 1.2 * (0.25 + 0.75 * len(own) / mean))
            if set(terms(text)) & set(own):
                scores.append((-round(s, 6), *key))
        out += [(q, n + 1, d, p, -s) for n, (s, d, p) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("block,first", [(4, 1), (16, 2), (1 << 20, 8)])
def test_best_pages_by_force(spark, monkeypatch, tmp_path, block, first):
    """Whatever the blocks, and from a written index too."""
    monkeypatch.setattr(retrieval, "BLOCK", block)
    pages = corpus(2, 150)
    queries = [(1, "w1 w2 w3"), (2, "w17"), (3, "é"), (4, None), (5, "absent"), (6, " ".join(f"w{i}" for i in range(30)))]
    rows = spark.createDataFrame(pages, "doc_id long, page_index int, text string")
    index = retrieval.build(rows)
    retrieval.write(index, f"file://{tmp_path}/index")
    asked = spark.createDataFrame(queries, "query_id int, text string")
    wanted = best(pages, queries, 5)
    for of in (index, retrieval.read(spark, f"file://{tmp_path}/index")):
        found = retrieval.search(of, asked, k=5, first=first)
        assert sorted(map(tuple, found.collect())) == [pytest.approx(x, abs=2e-6) for x in sorted(wanted)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert retrieval.search(retrieval.build(rows.where("false")), asked).count() == 0


def ranges(text: str, word: str) -> list[tuple[str, int, int]]:
    out, at = [], text.find(word)
    while at >= 0:
        out.append((word, at, at + len(word)))
        at = text.find(word, at + len(word))
    return out


@pytest.mark.parametrize("n,slice_", [(6, 100_000), (200, 100_000), (200, 50)])
def test_patterns_by_force(spark, monkeypatch, n, slice_):
    """Overlapping, nested and repeated words, in lists of any length, in one slice or several."""
    monkeypatch.setattr(patterns, "SLICE", slice_)
    r = random.Random(n)
    word = lambda: "".join(r.choice("aab\U0001f600é.") for _ in range(r.randint(1, 4)))
    words = list({word() for _ in range(n)})
    texts = ["".join(r.choice("aab\U0001f600é.x") for _ in range(r.randint(0, 60))) for _ in range(120)] + [None, "", "aaaa"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    given = spark.createDataFrame([(w,) for w in [*words, words[0], "", None]], "word string")
    found = patterns.occurrences(rows, given).select("i", "word", "char_start", "char_end").collect()
    assert sorted(map(tuple, found)) == sorted((i, *x) for i, t in enumerate(texts) if t for w in words for x in ranges(t, w))
    held = patterns.held(rows, given).select("i", "word").collect()
    assert sorted(map(tuple, held)) == sorted((i, w) for i, t in enumerate(texts) if t for w in words if w in t)
    any_ = patterns.holding(rows.union(rows), given).collect()
    assert sorted(x.i for x in any_) == sorted([i for i, t in enumerate(texts) if t and any(w in t for w in words)] * 2)
    assert patterns.occurrences(rows, given.where("false")).count() == patterns.holding(rows, given.where("false")).count() == 0


def test_hits_leave_in_bounded_batches():
    """a text is not repeated for its hits where it is not kept, and no batch that leaves holds more than a bound."""
    import pyarrow as pa
    from pyspark.sql import types as T

    n = 3 * patterns.HITS
    batch = pa.RecordBatch.from_pydict({"i": [7], "text": ["ab" * n]})
    more = T.StructType.fromDDL("word string, char_start int, char_end int")
    bare = list(patterns._batches(patterns._occurrences, ["ab"], 1, False, more)(iter([batch])))
    assert [b.schema.names for b in bare] == [["i", "word", "char_start", "char_end"]] * 3 and all(b.num_rows == patterns.HITS for b in bare)
    assert sum((b["char_start"].to_pylist() for b in bare), []) == list(range(0, 2 * n, 2))
    whole = patterns._batches(patterns._occurrences, ["ab"], 1, True, more)(iter([batch]))
    assert next(whole).nbytes <= 2 * patterns.HIT_BYTES


def test_ten_thousand_keywords(spark, sf_dir):
    """The same rows as a few at a time; the list is neither joined nor part of the plan."""
    from folioquarry.sources import layout_text as L

    blocks = L.blocks(L.read_documents(spark, sf_dir))
    real = ["the", "tion", "und", "est un"]
    many = search.keyword_table(spark, real + [f"nowhere {i}" for i in range(9_990)])
    few = search.keyword_table(spark, real)
    found = search.matches(blocks, many)
    rows = lambda df: sorted(map(str, df.select("doc_id", "page_index", "line_no", "keyword", "text_key").collect()))
    assert rows(found) == rows(search.matches(blocks, few))
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_rule_hits(spark):
    pages = spark.createDataFrame([(1, 0, "call 555 or 555, sign here"), (2, 0, None)], "doc_id long, page_index int, text string")
    rules = spark.createDataFrame([("555", "r1", "phone", "a"), ("555", "r2", "number", None), ("sign", "r3", "act", "b"), ("", "r4", "none", "c")], "word string, rule_id string, rule_tag string, agent_id string")
    got = sorted(map(str, spans.rule_hits(pages, rules).collect()))
    assert len(got) == 5 and all("hit_origin='lexicon'" in x for x in got)
    first = spans.rule_hits(pages, rules.where("rule_id = 'r3'").drop("agent_id")).first()
    assert (first.matched_text, first.category, first.agent_id, first.char_start, first.char_end) == ("sign", "act", None, 17, 21)


def lengths(texts: pd.Series) -> pd.Series:
    return texts.str.len().astype(str)


MODEL = answers.Model("m", "1", lengths)


@pytest.mark.parametrize("seed", range(6))
def test_admission_by_force(spark, seed):
    """As many as the budget pays for, in order of priority and fingerprint; the first that does not fit ends it."""
    r = random.Random(seed)
    rows = [(f"{r.choice('abc')}{i:060x}".ljust(64, "0")[:64], "t", r.randint(0, 9), r.randint(0, 2)) for i in range(60)]
    budget = r.choice([0, 20, 77, 150, 10_000])
    wanted, spent = [], 0
    for x in sorted(rows, key=lambda x: (x[3], x[0])):
        spent += x[2]
        if spent > budget:
            break
        wanted.append(x[0])
    given = spark.createDataFrame([*rows, ("x" * 64, "t", None, 0)], "fingerprint string, text string, cost long, priority int")
    assert sorted(x.fingerprint for x in answers.admitted(given, budget).collect()) == sorted(wanted)


def test_answers_are_paid_once(spark):
    inputs = spark.createDataFrame([(1, "aa", 2), (2, "aa", 2), (3, "bbb", 3), (4, None, 0)], "i int, text string, cost int")
    rows, cache = answers.serve(inputs, None, MODEL, budget=100)
    assert {r.i: (r.answer, r.origin) for r in rows.collect()} == {1: ("2", "model"), 2: ("2", "model"), 3: ("3", "model"), 4: ("0", "model")} and cache.count() == 3
    again, added = answers.serve(inputs, cache, MODEL, budget=0)
    assert {r.origin for r in again.collect()} == {"cache"} and added.count() == 0
    other, _ = answers.serve(inputs, cache, answers.Model("m", "2", lengths), budget=0)
    assert [r.origin for r in other.where("cost > 0").collect()] == ["deferred"] * 3
    old = cache.withColumn("created_at", F.lit(datetime.datetime(2000, 1, 1)).cast("timestamp"))
    aged, _ = answers.serve(inputs, old, MODEL, budget=100, max_age_seconds=60)
    assert {r.origin for r in aged.collect()} == {"model"}


def test_few_queries_are_asked_at_once(spark, monkeypatch):
    """both ways give the same pages; at once, pages meet queries in no shuffle but that of a task's best."""
    pages = [*corpus(7, 300), *((1000 + i, 0, "w1 w2 w2 w5") for i in range(40))]
    asked = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(1, 2 + i))) for i in range(25)] + [(99, None)], "query_id int, text string")
    rows = spark.createDataFrame(pages, "doc_id long, page_index int, text string").groupBy("doc_id", "page_index").agg(F.max("text").alias("text"))
    monkeypatch.setattr(retrieval, "PAGES", 7)
    at_once = retrieval.search(retrieval.build(rows), asked, k=4)
    plan = at_once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") == 1  # the one that made the pages
    assert not re.search(r"Exchange hashpartitioning\((term#\d+, block|query_id#\d+, doc_id)", plan)
    got = sorted(map(tuple, at_once.collect()))
    monkeypatch.setattr(retrieval, "DENSE", 0)
    monkeypatch.setattr(retrieval, "BLOCK", 16)
    by_blocks = sorted(map(tuple, retrieval.search(retrieval.build(rows), asked, k=4, first=1).collect()))
    assert got == [pytest.approx(x, abs=2e-6) for x in by_blocks] and len(got) == 100
