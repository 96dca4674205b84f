"""Refinement operators without SQL, on small rows."""

from pyspark.sql import functions as F

from folioquarry.operators import reading, refine
from folioquarry.plans import batch_plan, document_plan, pages_from_models
from folioquarry.queries import QUERIES
from folioquarry.sources import layout_text as L

BOX = "box struct<x: int, y: int, w: int, h: int>"
KEYS = "doc_id long, page_index int"


def test_two_column_lines(spark, sf_dir):
    rows = [(1, 0, 0, "left", (10, 0, 50, 16)), (1, 0, 1, "right", (310, 3, 50, 16)), (1, 0, 2, "more", (400, 5, 50, 16)), (1, 0, 3, "below", (10, 40, 50, 16))]
    blocks = spark.createDataFrame(rows, f"{KEYS}, line_no int, text string, {BOX}")
    got = refine.column_lines(reading.reading_order(blocks), F.lit(300.0)).orderBy("line").collect()
    assert [r.text for r in got] == ["left | right more", "below"]
    lines = QUERIES["two_column_lines"](spark, sf_dir)
    assert lines.count() == reading.reading_order(L.blocks(L.read_documents(spark, sf_dir))).select("doc_id", "page_index", "line").distinct().count()


def test_table_text_leaves_repeats_out(spark):
    rows = [(1, 0, 0, 1, "second cell"), (1, 0, 0, 0, "first cell"), (1, 0, 0, 2, "first  cell"), (1, 0, 1, 0, "first cell second cell"), (1, 0, 2, 0, "new")]
    cells = spark.createDataFrame([(*r, (10 * r[3], 0, 5, 5)) for r in rows], f"{KEYS}, row_index int, col_index int, text string, {BOX}")
    assert refine.table_text_distinct(cells).first().text == "first cell second cell\nnew"


def test_pages_of_models(spark):
    layout = spark.createDataFrame(
        [(1, 0, 0, "text", "own", (0, 0, 100, 50)), (1, 0, 1, "table", "t", (0, 60, 100, 50)), (1, 0, 2, "title", "fallback", (0, 500, 9, 9))], f"{KEYS}, line_no int, label string, text string, {BOX}"
    )
    lines = spark.createDataFrame(
        [(1, 0, 0, "b", (0, 20, 9, 9), 0.9), (1, 0, 1, "a", (0, 2, 9, 9), 0.9), (1, 0, 2, "free", (300, 0, 9, 9), 0.9), (1, 0, 3, "free", (301, 0, 9, 9), 0.9)], f"{KEYS}, line_no int, text string, {BOX}, confidence double"
    )
    marks = spark.createDataFrame([(1, 0, 0, "seal", (0, 500, 9, 9)), (1, 0, 1, "stamp", (700, 700, 9, 9))], f"{KEYS}, ordinal int, text string, {BOX}")
    got = {r.text: list(r.marks) for r in pages_from_models(layout, lines, marks).collect()}
    assert got == {"a\nb": [], "fallback": [0], "free": [], "stamp": []}


def test_seals(spark):
    seals = spark.createDataFrame([(1, 0, 0, "Company seal of 2020", (0, 0, 50, 50)), (1, 0, 1, "Other", (0, 0, 50, 50)), (1, 0, 2, "far", (900, 900, 5, 5))], f"{KEYS}, line_no int, text string, {BOX}")
    regions = spark.createDataFrame([(1, 0, 0, (10, 10, 50, 50))], f"{KEYS}, ordinal int, {BOX}")
    texts = spark.createDataFrame([(1, 0, "Company seal of 2021", (5, 5, 50, 50))], f"{KEYS}, text string, {BOX}")
    got = {r.line_no: (r.region, r.confirmed, r.render_text) for r in refine.annotate_seals(seals, regions, texts).collect()}
    assert got == {0: (0, True, True), 1: (0, False, False), 2: (None, False, True)}
    assert refine.rendered(refine.annotate_seals(seals, regions, texts)).count() == 2


def test_texts_of_artifacts(spark):
    names = {"a.md": True, "a_middle.json": True, "a.txt": False, "d/paddle_table_structure.json": False, "a.field_coordinates.json": False, "a.error.json": False}
    files = spark.createDataFrame([(n, "签字盖率") for n in names], "path string, text string")
    assert {r.path: r.text == "签字盖章" for r in refine.rewrite_texts(files).collect()} == names
    value = F.parse_json(F.lit('{"a": ["签字盖率", {"b": "(盖率)"}], "n": 1}'))
    assert spark.range(1).select(F.to_json(refine.correct_json(value))).first()[0] == '{"a":["签字盖章",{"b":"(盖章)"}],"n":1}'
    assert spark.range(1).select(refine.xml_safe(F.lit("a\x00b\tc\x1f"))).first()[0] == "ab\tc"
    page = refine.page_of_tasks(spark.range(10), 3, 2, "id")
    assert [r.id for r in page.collect()] == [3, 4]
    assert refine.marked(spark.range(1), "no model", "E1").first().table_cell_refine.warning == "no model"


def test_wire_drops_bad_pages(spark):
    wires = spark.createDataFrame([(1, '{"0": [{"t": "a"}], "x": [{"t": "b"}]}')], "doc_id long, json string")
    assert [(r.page_index, r.t) for r in refine.from_wire(wires, "t: string").collect()] == [(0, "a")]


def test_plans(spark, sf_dir):
    docs = L.read_documents(spark, sf_dir)
    pages, results = batch_plan(docs, done=docs.where("doc_id < 10").select("doc_id", F.lit(True).alias("success")), limit=5)
    assert sorted(r.doc_id for r in results.collect()) == [10, 11, 12, 13, 14]
    assert pages.where("error is not null").isEmpty()
    assert document_plan(docs).where("text is not null").count() > 0
