"""What keeps queries linear and fast on large tables, told from plans and counts rather than from clocks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from folioquarry.functions import geometry as G
from folioquarry.functions import text as T
from folioquarry.operators import spatial
from folioquarry.queries import ORACLE_SQL, QUERIES

from .compare import against_sql

#: Bytes of a method up to which the JVM compiles it.
COMPILED = 8000


def largest_method(spark, df) -> int:
    """The largest method generated for a query, as it is planned."""
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text))


@pytest.fixture
def planned_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", ["bbox_iou_pairs", "bbox_overlap_pairs", "greedy_iou_match"])
def test_joins_of_boxes_are_compiled(planned_once, sf_dir, name):
    """the measure of a pair does not make a method that the JVM leaves to its interpreter."""
    assert largest_method(planned_once, QUERIES[name](planned_once, sf_dir)) < COMPILED


def test_iou_pairs_of_the_sql(spark, sf_dir):
    ours, theirs = against_sql(QUERIES["bbox_iou_pairs"](spark, sf_dir), ORACLE_SQL["bbox_iou_pairs"], sf_dir)
    assert ours == theirs and ours


def test_measures_of_boxes_that_do_not_meet(spark):
    """Apart, side by side, empty, inverted or missing, boxes have 0 in common."""
    sides = [(0, 0, 4, 4), (4, 0, 4, 4), (9, 9, 1, 1), (1, 1, 0, 0), (3, 3, -2, 2), (1, 1, 2, 2), None]
    boxes = spark.createDataFrame([(i, s) for i, s in enumerate(sides)], "n int, box struct<x: int, y: int, w: int, h: int>")
    rows = boxes.alias("a").crossJoin(boxes.alias("b")).select("a.n", F.col("b.n").alias("m"), G.iou(F.col("a.box"), F.col("b.box")).alias("iou"), G.overlap(F.col("a.box"), F.col("b.box")).alias("overlap")).collect()

    def force(a, b):
        (ax, ay, aw, ah), (bx, by, bw, bh) = a or (0, 0, 0, 0), b or (0, 0, 0, 0)
        w, h = min(ax + aw, bx + bw) - max(ax, bx), min(ay + ah, by + bh) - max(ay, by)
        both = w * h if w > 0 < h else 0
        union = aw * ah + bw * bh - both
        return both / union if union > 0 else 0.0, both / min(max(1, aw * ah), max(1, bw * bh))

    assert all((r.iou, r.overlap) == pytest.approx(force(sides[r.n], sides[r.m])) for r in rows)


def all_characters(spark):
    """(code, text): every character between letters, but surrogates; those of ASCII also where all else is."""
    codes = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    return spark.createDataFrame([(c, f"Ab{chr(c)}9{e}") for e in ("", " é") for c in codes], "code int, text string").repartition(4)


def test_keys_of_all_characters(spark):
    """deleting characters gives the keys that patterns give, and word keys need no squeezed white space."""
    rows = all_characters(spark)
    words = T.fold(F.regexp_replace(T.squeeze(F.col("text")), "(?U)[\\W_]+", ""))
    breaks = T.fold(F.regexp_replace("text", f"[{T.WHITE}{T.MATCH_PUNCTUATION}]+", ""))
    assert rows.where((T.word_key(F.col("text")) != words) | (T.match_key(F.col("text")) != breaks)).collect() == []


def test_one_spaced_ascii(spark):
    texts = ["", " ", "a  b", "\ta\x0b \x1cb c ", " a", "a\x1f", "a b", "\n\n", "a\r\nb", "x \x1d y"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.one_spaced(F.col("t")).alias("o")).collect()
    assert [r.o for r in got] == [" ".join(r.t.split()) for r in got]


def test_keys_are_computed_once(planned_once, sf_dir):
    """no filter computes the key of a block a second time."""
    plan = QUERIES["dedupe_overlapping_blocks"](planned_once, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("(?U)[") == 2  # once for each side of the union


def test_deduped_blocks_of_the_sql(spark, sf_dir):
    ours, theirs = against_sql(QUERIES["dedupe_overlapping_blocks"](spark, sf_dir), ORACLE_SQL["dedupe_overlapping_blocks"], sf_dir)
    assert ours == theirs and ours


def test_blocks_of_three_models_are_computed_once(planned_once, sf_dir):
    """marks are put on blocks without finding out again which of these are equal."""
    assert "(?U)[" not in QUERIES["pages_of_three_models"](planned_once, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_filled_cells_as_shown(spark):
    """texts are put right where a cell holds them, blank ones of any kind left out."""
    sides = "struct<x: int, y: int, w: int, h: int>"
    cells = spark.createDataFrame([(1, 0, 0, (0, 0, 99, 99))], f"doc_id long, page_index int, cell_no int, box {sides}")
    lines = spark.createDataFrame([(1, 0, i, t, (0, 10 * i, 9, 9), 0.5) for i, t in enumerate([" a\t b ", "　 \t", "c  d"])], f"doc_id long, page_index int, line_no int, text string, box {sides}, confidence double")
    row = spatial.fill_cells(cells, lines, shown=T.squeeze).first()
    assert (row.text, row.n_blocks) == ("a b\nc d", 2)


def test_pieces_of_cells_are_computed_once(planned_once, sf_dir):
    """neither a filter nor a step of a walk computes texts, or which cells follow which, again."""
    plan = QUERIES["wrapped_cells"](planned_once, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("[^a-z]") == 2  # once for cells, once for their html
    assert plan.count("map_from_entries") == 1


def test_units_of_all_characters(spark):
    """F8: units split at characters are those split by a pattern."""
    breaks = "[\\n\\r\\t,;:!?，。；：！？、（）()【】\\[\\]<>《》]+"
    rows = spark.createDataFrame([(f"abcd{chr(c)}{chr(c)}efgh ij,{chr(c)}k lmnö{chr(c)}",) for c in range(0x11000) if not 0xD800 <= c < 0xE000], "text string").repartition(4)
    own = T.canonical(F.col("text"))
    parts = F.filter(F.transform(F.split(own, breaks), T.match_key), lambda u: F.char_length(u) >= 4)
    rule = F.array_union(parts, F.when(F.char_length(T.match_key(own)).between(4, 40), F.array(T.match_key(own))).otherwise(F.array().cast("array<string>")))
    assert rows.where(T.similarity_units(F.col("text")) != rule).collect() == []


def test_units_are_computed_from_one_canonical_text(spark):
    """F8: the canonical text, of which units and their keys are made, is computed once."""
    rows = spark.createDataFrame([("a",)], "text string").select(T.similarity_units(F.col("text")).alias("u"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("trim(") == 1


def test_whole_documents_are_worked_once(planned_once, sf_dir):
    """documents are extracted once, and texts of pages told once, for the tree and the Markdown alike."""
    plan = QUERIES["whole_documents"](planned_once, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("ArrowEvalPython") == 1


def test_redundant_texts_by_force(spark):
    """what is kept of a page, by sets in Python, is what its rule says text by text."""
    import random

    from folioquarry.operators.reading import not_redundant

    r = random.Random(5)
    word = lambda: "".join(r.choice("abé") for _ in range(r.randint(1, 5)))
    pages = []
    for p in range(60):
        texts = [", ".join(word() * r.randint(1, 4) for _ in range(r.randint(0, 5))) for _ in range(30)]
        pages.append((p, texts + [t[: len(t) // 2] for t in texts[:10]] + texts[5:8]))
    rows = spark.createDataFrame([*pages, (99, [])], "p int, texts array<string>")
    told = F.transform("texts", lambda t: F.struct(t.alias("text"), T.key_and_units(T.canonical(t)).alias("k")))
    items = F.transform(told, lambda e: F.struct(e["text"].alias("text"), e["k"]["key"].alias("key"), e["k"]["units"].alias("units")))
    for x in rows.select(items.alias("items")).select("items", not_redundant(F.col("items")).alias("kept")).collect():
        kept, keys, said = [], [], set()
        for text, key, units in x["items"]:
            own = set(units)
            known = any(key == k or (len(key) >= 12 and key in k) or (len(k) >= 12 and k in key) for k in keys)
            if key and not known and not (own and said and len(own & said) / len(own) >= 0.82):
                kept.append(text), keys.append(key)
                said |= own
        assert x["kept"] == kept


def test_keys_and_units_are_those_of_their_rules(spark):
    """one pass gives the key and the units that single passes give, with corrections and letters whose folding depends on others too."""
    texts = ["", None, " Ab, CD-ef; ΑΣ, ΟΔΟΣ.x", "签字盖率, （盖率）！x", "国发[2020] 5 号, ab 国发(2021)6号", "Straße: ÉTÉ été\n\rİstanbul", "abcd，efgh abcd"]
    own = T.canonical(F.col("t"))
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(T.key_and_units(own).alias("k"), T.match_key(own).alias("key"), F.filter(F.transform(F.split(F.translate(own, T.UNIT_BREAKS, "\n" * len(T.UNIT_BREAKS)), "\n"), T.match_key), lambda u: F.char_length(u) >= 4).alias("parts")).collect()
    for x in got:
        assert x.k.key == x.key and x.k.units == list(dict.fromkeys([*x.parts, *([x.key] if 4 <= len(x.key) <= 40 else [])]))
