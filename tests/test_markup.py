"""Open JSON and Markdown: only what is meant is changed, and nothing is lost."""

import json
import random
import re

from pyspark.sql import functions as F

from folioquarry.functions import jsontree
from folioquarry.functions import markdown as M
from folioquarry.operators import documents as D
from folioquarry.operators import refine, repair


def changed(value, change):
    if isinstance(value, dict):
        return {k: changed(v, change) for k, v in value.items()}
    if isinstance(value, list):
        return [changed(v, change) for v in value]
    return change(value) if isinstance(value, str) else value


def trees(seed: int, n: int) -> list:
    r = random.Random(seed)
    pieces = ['"', "\\", "/old", ":", ",", "{", "}", "[", "]", "\n", "\t", "é", "日", "a b", "\\n", "\x07", "\x01", '":"', "盖率", "/"]
    text = lambda: "".join(r.choice(pieces) for _ in range(r.randint(0, 6)))

    def one(depth: int):
        kind = r.randint(0, 5 if depth else 3)
        if kind == 4:
            return [one(depth - 1) for _ in range(r.randint(0, 4))]
        if kind == 5:
            return {text() + str(i): one(depth - 1) for i in range(r.randint(0, 4))}
        return [text(), r.randint(-9, 9), None, r.random() < 0.5][kind]

    return [one(4) for _ in range(n)]


def test_strings_of_any_tree(spark):
    """Every string that is no key is changed, once, whatever characters it and the keys hold."""
    given = trees(3, 300)
    rows = spark.createDataFrame([(i, json.dumps(t, ensure_ascii=i % 2 == 0)) for i, t in enumerate(given)], "i int, t string")
    got = rows.select("i", F.to_json(jsontree.map_strings(F.parse_json("t"), lambda s: F.concat(F.lit('<"'), s, F.lit("\\>")))).alias("t")).collect()
    assert {r.i: json.loads(r.t) for r in got} == {i: changed(t, lambda s: f'<"{s}\\>') for i, t in enumerate(given)}


def test_paths_that_begin_with_the_folder(spark):
    tree = {"/old/k": 'see "/old/x" here', "a": ["/old/x", "/old", "/older", "x /old/y", '/old/"q"', "/old/auto/z", ["/old/"]], "b": {"c": "/old/日"}}
    move = lambda s: "/n/" + s[10:] if s.startswith("/old/auto/") else "/new" if s == "/old" else "/new" + s[4:] if s.startswith("/old/") else s
    row = spark.createDataFrame([(json.dumps(tree),), (None,)], "t string")
    got = [r[0] for r in row.select(F.to_json(D.relocated(F.parse_json("t"), [("/old/auto", "/n"), ("/old/", "/new/")]))).collect()]
    assert json.loads(got[0]) == changed(tree, move) and got[1] is None


def test_corrections_leave_keys(spark):
    row = spark.createDataFrame([('{"签字盖率":["签字盖率","x"],"n":1.50}',)], "t string")
    got = row.select(F.to_json(refine.correct_json(F.parse_json("t")))).first()[0]
    assert json.loads(got) == {"签字盖率": ["签字盖章", "x"], "n": 1.5}


def test_json_safe_values(spark):
    import datetime

    row = spark.createDataFrame([(float("nan"), [float("inf"), 1.5], datetime.date(2024, 1, 2), {3: b"ab"}, None)], "a double, b array<double>, c date, d map<int, binary>, e struct<f: float>")
    got = jsontree.safe_rows(row).first()
    assert (got.a, got.b, got.c, got.d, got.e) == (None, [None, 1.5], "2024-01-02", {"3": "YWI="}, None)


def random_markdown(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    lines = ["", " ", "| a | b |", "| --- | :-: |", "|---|", "| x\\|y | |", "text", "a | b", "印章：", "<table><tr><td>1</td></tr></table>", "pre<TABLE>\n<tr><th>h</th></tr>", "</table> post", "|", "- item", "\tcode"]
    return ["\n".join(r.choice(lines) for _ in range(r.randint(0, 12))) + r.choice(["", "\n"]) for _ in range(n)]


def test_segments_lose_nothing(spark):
    texts = [*random_markdown(5, 400), "印章：\n\na\nb\n", "x\n\n印章：\n\na", "x\n\n印章：\n\na\n\nb\n", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.s for r in rows.select("i", M.segments(F.col("t")).alias("s")).collect()}
    assert all("".join(s.text for s in got[i]) == (t or "") for i, t in enumerate(texts))
    for i, t in enumerate(texts):
        for s in got[i]:
            if s.kind == "pipe":
                own = s.text.splitlines()
                assert len(own) > 1 and all(x.strip().startswith("|") and x.strip().endswith("|") for x in own)
            elif s.kind == "html":
                assert s.text.lower().startswith("<table") and s.text.lower().endswith("</table>")
    closing = [[s.kind for s in got[i]][-1:] for i in range(400, 404)]
    assert closing == [["seal"], ["seal"], ["prose"], []]


def test_html_tables_become_pipes_once(spark):
    texts = random_markdown(7, 200)
    texts += ["a<table><tr><td>x &amp; y</td><td>&eacute;|&#65;</td></tr><tr><td>1</td></tr></table>b", "<table></table>", "<table><tr></tr></table>\nx", "a\n\n<table><tr><td>&copy;</td></tr></table>\n\n\nb\n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    once = M.pipes_for_html(rows, "t")
    twice = {r.i: r.t for r in M.pipes_for_html(once, "t").collect()}
    got = {r.i: r.t for r in once.collect()}
    assert got == twice
    assert got[200] == "a\n\n| x & y | é\\|A |\n| --- | --- |\n| 1 |\n\nb" and got[201] == "<table></table>" and got[202] == "<table><tr></tr></table>\nx"
    assert got[203] == "a\n\n| © |\n| --- |\n\n\nb\n"
    prose = lambda t: re.sub(r"(?is)<table\b.*?</\s*table\s*>", " ", t)
    words = lambda t: [x for x in t.split() if x in ("text", "item", "code", "post", "pre")]
    assert all(words(prose(t)) == words(re.sub(r"\| [^\n]*(item|text|code|post|pre)[^\n]* \|", "", prose(got[i]))) for i, t in enumerate(texts))


def test_tables_and_texts_made_anew(spark):
    """Halves of lines, seals in the closing section, cells in place of a text's tables with its footer apart."""
    box = "box struct<x: int, y: int, w: int, h: int>"
    docs = spark.createDataFrame([(1, "lost", "ppocrv5"), (2, "lost", "seal_vl_crops_ppocrv5"), (3, "# t\n\n| o | o |\n| --- | --- |\n| o | o |http://f\n", "ppstructurev3"), (4, "kept", "ppocrv5"), (5, None, "x")], "doc_id long, markdown string, mode string")
    blocks = [(1, 0, "text", "left", (260, 183, 70, 18)), (1, 0, "text", "right", (567, 183, 70, 18)), (1, 0, "text", "alone", (280, 248, 72, 18)), (1, 0, "text", "wide", (520, 222, 200, 18)), (1, 1, "text", "next", (1, 1, 5, 5)),
              (2, 0, "text", "body", (100, 400, 300, 20)), (2, 0, "seal_text", "seal", (637, 598, 209, 146))]
    cells = [(3, 0, 0, r, c, t, (x, 20 * r, 9, 9)) for r, c, x, t in [(0, 0, 0, "名"), (0, 1, 40, "签字信息"), (0, 1, 80, "z"), (1, 0, 0, "a|b"), (1, 1, 40, "7"), (1, 1, 80, "")]]
    got = repair.rebuilt_markdown(
        docs, spark.createDataFrame(blocks, f"doc_id long, page_index int, block_type string, text string, {box}"),
        spark.createDataFrame(cells, f"doc_id long, page_index int, table_no int, row_index int, col_index int, text string, {box}"),
    )
    assert {r.doc_id: r.markdown for r in got.collect()} == {
        1: "left | right\n\nwide\n\nalone\n\nnext\n", 2: "body\n\n印章：\n\nseal\n", 4: "kept", 5: "",
        3: "# t\n\n| 名 | 签字信息 | z |\n| --- | --- | --- |\n| a\\|b |  |  |\n\nhttp://f\n",
    }


def test_one_empty_line_between_tables(spark):
    """tables that follow each other, given or made of HTML, stand one empty line apart."""
    one, two = "| a |\n| --- |\n| b |", "| c |\n| --- |"
    rows = spark.createDataFrame([("lost", [one, two, one])], "markdown string, tables array<string>")
    assert rows.select(M.rebuilt_tables(F.col("markdown"), F.col("tables"))).first()[0] == f"lost\n\n{one}\n\n{two}\n\n{one}"
    html = spark.createDataFrame([("x<table><tr><td>a</td></tr><tr><td>b</td></tr></table><table><tr><td>c</td></tr></table>y",)], "markdown string")
    once = M.pipes_for_html(html)
    assert once.first()[0] == M.pipes_for_html(once).first()[0] == f"x\n\n{one}\n\n{two}\n\ny"
