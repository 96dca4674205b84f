"""Repairs of tables and Markdown on the cases that they are for."""

from pyspark.sql import functions as F

from folioquarry.operators import documents as D
from folioquarry.operators import repair

BOX = "box struct<x: int, y: int, w: int, h: int>"
KEYS = "doc_id long, page_index int"


def test_fragments_and_vertical_writing(spark):
    cells = spark.createDataFrame([(1, 0, 0, (0, 0, 100, 80)), (1, 0, 1, (100, 0, 100, 80)), (2, 0, 0, (0, 0, 80, 160)), (3, 0, 0, (0, 0, 9, 9))], f"{KEYS}, cell_no int, {BOX}")
    rows = [(1, 0, i, t, (x, 10, 24, 20)) for i, (t, x) in enumerate([("执行", 8), ("事务", 34), ("合伙人", 60), ("2025", 112), ("年6", 140), ("月19日", 164)])]
    rows += [(2, 0, i, t, b) for i, (t, b) in enumerate([("ace", (10, 10, 24, 72)), ("bdf", (36, 10, 24, 72)), ("gh", (18, 84, 34, 22)), ("ij", (14, 108, 42, 22)), ("klm", (10, 132, 52, 22))])]
    fragments = spark.createDataFrame(rows, f"{KEYS}, ordinal int, text string, {BOX}")
    got = {(r.doc_id, r.cell_no): (r.text, r.n_fragments) for r in repair.fragments_into_cells(cells, fragments, "doc_id", "page_index").collect()}
    assert got == {(1, 0): ("执行事务合伙人", 3), (1, 1): ("2025年6月19日", 3), (2, 0): ("abcdefghijklm", 5), (3, 0): ("", 0)}


def test_upside_down_tables(spark):
    texts = ["姓名", "身份证号码", "结果", "甲某", "A-0001", "成功"]
    turned = [(120, 80, 60, 40), (60, 80, 60, 40), (0, 80, 60, 40), (120, 0, 60, 40), (60, 0, 60, 40), (0, 0, 60, 40)]
    straight = [(0, 0, 60, 40), (60, 0, 60, 40), (120, 0, 60, 40), (0, 40, 60, 80), (60, 40, 60, 80), (120, 40, 60, 80)]
    rows = [(1, 0, i, t, b) for i, (t, b) in enumerate(zip(texts, turned, strict=True))] + [(2, 0, i, t, b) for i, (t, b) in enumerate(zip(texts, straight, strict=True))] + [(3, 0, 0, "one", (5, 5, 5, 5))]
    up = repair.upright(spark.createDataFrame(rows, f"{KEYS}, ordinal int, text string, {BOX}"), "doc_id", "page_index")
    cells = spark.createDataFrame([(d, 0, i, b) for d in (1, 2) for i, b in enumerate(straight)], f"{KEYS}, cell_no int, {BOX}")
    got = repair.fragments_into_cells(cells, up, "doc_id", "page_index").orderBy("doc_id", "cell_no").collect()
    assert [r.text for r in got] == texts * 2
    assert {(r.doc_id, r.flipped) for r in up.collect()} == {(1, True), (2, False), (3, False)}


def test_suspicious_cells(spark):
    cells = spark.createDataFrame([(1, 0, 0, "", (0, 40, 60, 80)), (1, 0, 1, "X", (120, 40, 60, 80)), (1, 0, 2, "Ok", (60, 40, 60, 80)), (1, 0, 3, None, (300, 0, 9, 9))], f"{KEYS}, cell_no int, text string, {BOX}")
    lines = spark.createDataFrame([(1, 0, 0, "甲某", (5, 45, 50, 35)), (1, 0, 1, "成功", (125, 45, 50, 35)), (1, 0, 2, "no", (65, 45, 50, 35))], f"{KEYS}, line_no int, text string, {BOX}")
    got = {r.cell_no: (r.text, r.page_text_fallback) for r in repair.filled_from_page(cells, lines).collect()}
    assert got == {0: ("甲某", True), 1: ("成功", True), 2: ("Ok", False), 3: (None, False)}


def test_days_of_serial_numbers(spark):
    one = lambda t: spark.range(1).select(repair.serial_day(F.lit(t).cast("string"))).first()[0]
    assert one("业务流水号:510604Y3202505140001") == "2025年5月14日"
    assert [one(t) for t in ("A20251399990001", "Y3202513140001", "", None)] == [None] * 4
    text = "流水号:510604Y3202505140001\n\n| 姓名 | 实名认证时间 | 结果 |\n| --- | --- | --- |\n| 向 |  |  |\n| 向 | 2日 | 成功 |\nafter | no"
    got = spark.range(1).select(repair.repaired_pipes(F.lit(text))).first()[0]
    assert got.count("2025年5月14日") == 2 and "| 向 | 2025年5月14日 |  |" in got and got.endswith("after | no")


def test_seals_come_last(spark):
    text = "正文\n\n![](images/seal.jpg)  \n公司\n\n页脚\n"
    texts = lambda *t: F.array(*map(F.lit, t)).cast("array<string>")
    made = lambda t, found: spark.range(1).select(repair.with_seals(F.lit(t), texts("公司"), texts("images/seal.jpg"), found)).first()[0]
    once = made(text, texts("代码 91", "代码 91"))
    assert once == "正文\n\n页脚\n\n印章：\n\n代码 91\n" == made(once, texts("代码 91"))
    assert made(text, texts()) == "正文\n\n页脚\n\n印章：\n\n公司\n"
    assert made("印章：\n\nold\n", texts("x")) == "印章：\n\nx\n"


def test_seal_titles_within_a_text_are_text(spark):
    """Only a section that closes the text is replaced, and only by one."""
    texts = lambda *t: F.array(*map(F.lit, t)).cast("array<string>")
    made = lambda t, own, found: spark.range(1).select(repair.with_seals(F.lit(t), texts(*own), texts(), texts(*found))).first()[0]
    form = "甲方盖章\n印章：\n日期 2024\n第二条 正文\n\n印章：\n\n表格\n\n末尾"
    assert made(form, [], []) == form
    assert made(form, ["公司"], []) == form + "\n\n印章：\n\n公司\n"
    assert made(form + "\n\n印章：\n\n旧\n旧二\n", [], ["新"]) == form + "\n\n印章：\n\n新\n"
    assert made("正文\n\n印章：\n\n旧\n", [], []) == "正文\n\n印章：\n\n旧\n"
    assert made("", [], ["新"]) == "印章：\n\n新\n" and made(None, [], []) == ""


def test_days_beside_escaped_pipes(spark):
    text = "510604Y3202505140001\n| 名 | a\\|b | 日期 |\n| --- | --- | --- |\n| x | c\\|d |  |\n| y | e | 2021年1月2日 |\n\nz | w |  |\n"
    got = spark.range(1).select(repair.repaired_pipes(F.lit(text))).first()[0]
    assert got == text.replace("| x | c\\|d |  |", "| x | c\\|d | 2025年5月14日 |")


def test_options_that_are_no_numbers():
    import pytest

    from folioquarry.operators.base import OperatorError

    assert D.positive("2.5", "t") == 2.5
    for bad in (True, 0, -1, "x", None, float("nan")):
        with pytest.raises(OperatorError, match="t must be a positive number"):
            D.positive(bad, "t")
    with pytest.raises(ValueError):
        D.options_of(F.lit(None), "other")
