"""Column functions against plain Python."""

import difflib
import html
import random

import pytest
from pyspark.sql import functions as F

from folioquarry.functions import geometry as G
from folioquarry.functions import text as T
from folioquarry.functions import values as V


def column(spark, expression, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


BOX = "struct<x: int, y: int, w: int, h: int>"


def boxes(n=200, seed=5):
    r = random.Random(seed)
    one = lambda: (r.randint(0, 60), r.randint(0, 60), r.randint(0, 40), r.randint(0, 40))
    return [(one(), one()) for _ in range(n)]


def overlap(a, b):
    w = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0])
    h = min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
    return w * h if w > 0 and h > 0 else 0


def test_measures(spark):
    rows = boxes()
    a, b = F.col("a"), F.col("b")
    got = spark.createDataFrame(rows, f"a {BOX}, b {BOX}").select(
        G.iou(a, b), G.overlap(a, b), G.overlap(b, a), G.center_inside(a, b), G.center_distance(a, b), G.vertical_overlap(a, b)
    ).collect()
    for (p, q), (iou, score, back, inside, apart, vertical) in zip(rows, got, strict=True):
        i = overlap(p, q)
        union = p[2] * p[3] + q[2] * q[3] - i
        assert iou == pytest.approx(i / union if union else 0)
        assert score == back == pytest.approx(i / min(max(1, p[2] * p[3]), max(1, q[2] * q[3])))
        cx, cy = p[0] + p[2] / 2, p[1] + p[3] / 2
        assert inside == (q[0] <= cx <= q[0] + q[2] and q[1] <= cy <= q[1] + q[3])
        assert apart == pytest.approx((abs(cx - q[0] - q[2] / 2) + abs(cy - q[1] - q[3] / 2)) / max(1, *p[2:], *q[2:]))
        common = min(p[1] + p[3], q[1] + q[3]) - max(p[1], q[1])
        assert vertical == pytest.approx(common / max(1, min(p[3], q[3])) if common > 0 else 0)


def test_boxes_of_lists(spark):
    rows = [([0.5, 1.5, 11.0, 4.0],), ([9.0, 9.0, 1.0, 2.0],), ([0.0, 0.0, 4.0, 0.0, 4.0, 2.0, 0.0, 2.0],), ([1.0, 2.0],), (None,)]
    c = F.col("c")
    got = spark.createDataFrame(rows, "c array<double>").select(G.from_corners(c), G.from_corners(c, order="swap"), G.from_any(c)).collect()
    as_tuple = lambda v: None if v is None else tuple(v)
    assert [as_tuple(r[0]) for r in got] == [(0, 2, 10, 2), (9, 9, 0, 0), (0, 0, 4, 0), None, None]
    assert [as_tuple(r[1]) for r in got[:2]] == [(0, 2, 10, 2), (1, 2, 8, 7)]
    assert as_tuple(got[2][2]) == (0, 0, 4, 2)


def test_corrections(spark):
    texts = ["(盖率)和签字盖率", "签字（盖率）", "粤府办[2021] 12号", "某函(2020)7号", "plain [2020] text"]
    got = column(spark, T.correct(F.col("t")), [(t,) for t in texts], "t string")
    assert got == ["(盖章)和签字盖章", "签字（盖章）", "粤府办〔2021〕 12号", "某函〔2020〕7号", "plain [2020] text"]
    again = column(spark, T.correct(F.col("t")), [(t,) for t in got], "t string")
    assert again == got


def test_keys(spark):
    texts = ["Straße, 12 (a)", "  甲 乙　丙 ", "É-é_É", None, "", "a b\x1cc"]
    assert column(spark, T.match_key(F.col("t")), [(t,) for t in texts], "t string") == ["strasse12a", "甲乙丙", "ééé", "", "", "abc"]
    assert column(spark, T.squeeze(F.col("t")), [(t,) for t in texts], "t string") == ["Straße, 12 (a)", "甲乙丙", "É-é_É", "", "", "a b c"]
    assert column(spark, T.word_key(F.col("t")), [(t,) for t in texts], "t string") == ["strasse12a", "甲乙丙", "ééé", "", "", "abc"]


def test_html(spark):
    text = "<p>a&amp;b<br/>c</p><table><tr><td>1</td><TH x=1> 2 <b>3</b></th></tr><tr><td>1</td></tr></table>"
    assert column(spark, T.html_to_text(F.col("t")), [(text,)], "t string") == [html.unescape("a&amp;b\nc 1 2 3\n1")]
    assert column(spark, T.html_cells(F.col("t")), [(text,)], "t string") == [["1", "2 3"]]
    cells = "<tr><td>a &amp; b</td><td> a&nbsp;&#38; b </td><td>&lt;i&gt;</td><td></td></tr>"
    assert column(spark, T.html_cells(F.col("t")), [(cells,), ("none",), (None,)], "t string") == [["a & b", "<i>"], [], []]
    assert column(spark, T.table_texts(F.col("t")), [(cells + "<tr></tr><tr><td></td></tr>",)], "t string") == [[["a & b", "a & b", "<i>", ""], [""]]]
    assert column(spark, T.looks_like_table(F.col("t")), [(text,), ("tablet <b>",), (None,)], "t string") == [True, False, False]


def test_similarity(spark):
    pairs = [("abcd", "bcde"), ("", "x"), ("same", "same"), ("kitten sitting", "sitting kitten")]
    got = column(spark, T.sequence_ratio(F.col("a"), F.col("b")), pairs, "a string, b string")
    assert got == [pytest.approx(difflib.SequenceMatcher(None, a, b).ratio()) for a, b in pairs]
    near = column(spark, T.near_duplicates(F.col("a"), F.col("b")), [*pairs, ("abcdefghijkl", "xxabcdefghijklyy")], "a string, b string")
    assert near == [True, False, True, difflib.SequenceMatcher(None, *pairs[3]).ratio() >= 0.62, True]


def test_denoise(spark):
    got = column(spark, T.denoise(F.col("t")), [("·Ａ１　 ｂ​ ·",), (None,), ("",)], "t string")
    assert got == ["A1 b ", None, ""]


def test_coercion(spark):
    texts = [("0.5",), ("NaN",), ("7",), ("x",), (None,), ("Infinity",)]
    assert column(spark, V.confidence(F.col("t")), texts, "t string") == [0.5, None, None, None, None, None]
    assert column(spark, V.as_double(F.col("t")), texts, "t string") == [0.5, None, 7.0, None, None, None]
    assert column(spark, V.as_boolean(F.col("t"), True), [("YES",), ("off",), ("?",), (None,)], "t string") == [True, False, True, True]


def test_names(spark):
    paths = [("a/b/Plan 1.PDF",), ("x.tar.gz",), ("none",), ("..hidden..",)]
    assert column(spark, T.stem(F.col("p")), paths, "p string") == ["Plan 1", "x.tar", "none", "..hidden."]
    texts = [("a b/c",), ("???",), (None,), (" .x:y. ",), ("甲 乙",)]
    assert column(spark, T.safe_part(F.col("p")), texts, "p string") == ["a b_c", "unnamed", "unnamed", "x_y", "甲 乙"]
    assert column(spark, T.safe_ascii(F.col("p")), texts, "p string") == ["a_b_c", "unknown", "unknown", "x_y", "unknown"]
    assert column(spark, T.safe_stem(F.col("p")), [("d/a b.pdf",), ("???.pdf",), ("d/甲 乙.png",)], "p string") == ["a b", "document", "甲 乙"]
    assert column(spark, T.safe_id(F.col("p")), [("d/a b.pdf",), ("???.pdf",), ("d/甲.png",)], "p string") == ["a_b", "document", "document"]
    assert column(spark, T.padded_number(F.col("p")), [("7",), ("12.0",), ("1234",), ("x1",)], "p string") == ["007", "012", "1234", "x1"]


def test_common_length_bounds_the_matcher():
    import difflib
    import random

    r = random.Random(1)
    for _ in range(300):
        a, b = ("".join(r.choice("abcdeé ") for _ in range(r.randint(0, 260))) for _ in range(2))
        table = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, table[j + 1] = table[j + 1], last + 1 if x == y else max(table[j + 1], table[j])
        assert T.common_length(a, b) == table[-1]
        ratio = difflib.SequenceMatcher(None, a, b).ratio()
        assert ratio <= 2 * table[-1] / max(1, len(a) + len(b)) + 1e-12 or not (a or b)
        assert T.texts_alike(a, b) == (ratio >= T.ALIKE) or not (a or b)


def test_entities_decoded_in_the_jvm(spark):
    import html
    import random

    r = random.Random(2)
    pieces = ["&amp;", "&lt;", "&#65;", "&#xe9;", "&#x65e5;", "&eacute;", "&amp", "&#128;", "&#0;", "x", ";", "&", "#", "&#x1F600;", "&nbsp;", "&#99999999;", "&quot;", "lt;", "65;", "é"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 7))) for _ in range(600)] + [None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {x.i: x.t for x in T.with_decoded(rows, "t").collect()}
    assert got == {i: None if t is None else html.unescape(t) for i, t in enumerate(texts)}
    assert 20 < rows.where(T.needs_python(F.col("t"))).count() < 560


def planned(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_open_values_are_parsed_once(spark):
    """however many shapes of a box are tried."""
    texts = spark.createDataFrame([('{"x":1,"y":"2","w":3,"h":4}',), ("[9,8,1,2]",), ('[[5,6],[1],["a",2],[7,9,9]]',), ('{"a":1}',)], "t string")
    boxes = texts.select(G.from_open(F.parse_json("t")).alias("b"))
    assert planned(boxes).count("parseJson") + planned(boxes).count("parse_json") <= 2  # a call of it names it twice
    assert [r.b and tuple(r.b) for r in boxes.collect()] == [(1, 2, 3, 4), (1, 2, 8, 6), (5, 6, 2, 3), None]


def test_corners_are_computed_once(spark):
    """The corners that a box is made of."""
    boxes = spark.range(3).select(G.from_corners(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda x: (x * F.col("id")).cast("double"))).alias("b"))
    assert planned(boxes).count("sequence") + planned(boxes).count("[1,2,3,4]") <= 1 and [tuple(r.b) for r in boxes.collect()] == [(0, 0, 0, 0), (1, 2, 2, 2), (2, 4, 4, 4)]


def test_decoding_does_not_part_rows(spark):
    """what a decoded column is made of is computed once for a row."""
    rows = spark.createDataFrame([(0, "a &lt; &hearts;"), (1, "b &#65;"), (2, None)], "i int, t string")
    got = T.with_decoded(rows.withColumn("t", F.regexp_replace("t", "^[ab] ", "")), "t")
    assert "Union" not in planned(got) and planned(got).count("regexp_replace(t") == 1
    assert sorted((r.i, r.t) for r in got.collect()) == [(0, "< ♥"), (1, "A"), (2, None)]


def test_seconds_per_page_near_halves(spark):
    """as the SQL rounds, where a quotient is a half or next to one."""
    import duckdb

    elapsed = [32.5245, 69.37650000000001, 7.1754999999999995, 55755.330500000004, 0.0015, 2.5e-4, 1e305, 0.0]
    none = F.lit(None).cast("double")
    rows = spark.createDataFrame([(x,) for x in elapsed], "x double")
    got = [r[0] for r in rows.coalesce(1).select(V.seconds_per_page(none, F.col("x"), F.lit(1), none)).collect()]
    assert got == [duckdb.execute("SELECT round_even(?::DOUBLE, 3)", [x]).fetchone()[0] for x in elapsed]
