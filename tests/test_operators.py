"""Order-dependent operators against plain Python, and the user-operator machinery."""

import difflib
import json
import re

import pytest
from pyspark.sql import functions as F

from folioquarry import schemas as S
from folioquarry.functions import geometry as G
from folioquarry.operators import base, extract, reading, report, spatial, tables
from folioquarry.queries import QUERIES
from folioquarry.sources import files, layout_json as J, layout_text as L


def pages_of(rows, *keys):
    out = {}
    for r in rows:
        out.setdefault(tuple(r[k] for k in keys), []).append(r)
    return out


@pytest.fixture(scope="module")
def blocks(spark, sf_dir):
    return L.blocks(L.read_documents(spark, sf_dir))


def overlap(a, b):
    w = min(a.x + a.w, b.x + b.w) - max(a.x, b.x)
    h = min(a.y + a.h, b.y + b.h) - max(a.y, b.y)
    return w * h / min(max(1, a.w * a.h), max(1, b.w * b.h)) if w > 0 and h > 0 else 0.0


def test_reading_order(spark, sf_dir, blocks):
    got = pages_of(QUERIES["reading_order"](spark, sf_dir).collect(), "doc_id", "page_index")
    for key, rows in pages_of(blocks.collect(), "doc_id", "page_index").items():
        lines = []
        for y, x, t in sorted((float(r.box.y), float(r.box.x), r.text) for r in rows):
            if lines and abs(y - sum(i[0] for i in lines[-1]) / len(lines[-1])) <= 12:
                lines[-1].append((y, x, t))
            else:
                lines.append([(y, x, t)])
        expected = [(n, t) for n, line in enumerate(lines) for y, x, t in sorted(line, key=lambda i: (i[1], i[0], i[2]))]
        assert [(r.line, r.text) for r in sorted(got[key], key=lambda r: r.place)] == expected


def test_page_text_has_no_redundant_pair(spark, sf_dir):
    from folioquarry.functions.text import canonical_key

    text = QUERIES["redundancy_filter"](spark, sf_dir).where("text is not null")
    lines = text.select("doc_id", "page_index", F.posexplode(F.split("text", "\n")).alias("i", "t")).select("doc_id", "page_index", canonical_key(F.col("t")).alias("k"))
    for rows in pages_of(lines.collect(), "doc_id", "page_index").values():
        keys = [r.k for r in rows]
        assert all(keys) and len(set(keys)) == len(keys)
        assert not any(len(a) >= 12 and a in b for a in keys for b in keys if a is not b)


def test_redundancy_rules(spark):
    items = [("A first line of text", 0), ("a first line, of text", 1), ("first line of text and", 2), ("Other", 3), ("", 4)]
    df = spark.createDataFrame([(1, 0, p, t) for t, p in items], "doc_id long, page_index int, place int, text string")
    assert reading.page_text(df).first().text == "A first line of text\nfirst line of text and\nOther"
    assert reading.page_text(df.where("place = 4")).first().text is None


def clusters(values, within):
    out = []
    for v in sorted(values):
        if out and abs(v - sum(out[-1]) / len(out[-1])) <= within:
            out[-1].append(v)
        else:
            out.append([v])
    return [sum(c) / len(c) for c in out]


def test_grid(spark, sf_dir):
    rows = pages_of(QUERIES["grid_index"](spark, sf_dir).collect(), "doc_id", "page_index")
    for page in rows.values():
        ys, xs = [r.y + r.h / 2 for r in page], [r.x + r.w / 2 for r in page]
        down, across = clusters(ys, max(8, 16 * 0.6)), clusters(xs, max(8, 120 * 0.6))
        for r in page:
            assert r.row_index == min(range(len(down)), key=lambda i: abs(down[i] - (r.y + r.h / 2)))
            assert r.col_index == min(range(len(across)), key=lambda i: abs(across[i] - (r.x + r.w / 2)))


def test_greedy_match_uses_a_candidate_once(spark):
    box = lambda x: (x, 0, 10, 10)
    schema = "doc_id long, page_index int, {} int, box struct<x: int, y: int, w: int, h: int>"
    t = spark.createDataFrame([(1, 0, 0, box(0)), (1, 0, 1, box(1)), (1, 0, 2, box(90))], schema.format("table_no"))
    c = spark.createDataFrame([(1, 0, 0, box(0)), (1, 0, 1, box(1)), (2, 0, 0, box(90))], schema.format("candidate_no"))
    got = {r.table_no: r.candidate_no for r in spatial.greedy_match(t, c).collect()}
    assert got == {0: 0, 1: 1, 2: None}
    swapped = {r.table_no: r.candidate_no for r in spatial.greedy_match(t.where("table_no = 1"), c).collect()}
    assert swapped == {1: 0}


def test_dedupe_keeps_the_first(spark, sf_dir, blocks):
    kept = QUERIES["dedupe_overlapping_blocks"](spark, sf_dir).collect()
    assert {(r.doc_id, r.line_no) for r in kept} <= {(r.doc_id, r.line_no) for r in blocks.select("doc_id", "line_no").collect()} | {(r.doc_id, r.line_no) for r in kept if r.line_no >= 100000}
    for rows in pages_of(kept, "doc_id", "page_index").values():
        for i, a in enumerate(rows):
            assert not any(a.text == b.text and overlap(a, b) >= 0.5 for b in rows[i + 1 :])


def test_annotate_appends_what_meets_nothing(spark):
    schema = "doc_id long, page_index int, {} int, text string, box struct<x: int, y: int, w: int, h: int>"
    b = spark.createDataFrame([(1, 0, 0, "a", (0, 0, 10, 10)), (1, 0, 1, "b", (5, 0, 10, 10))], schema.format("line_no"))
    m = spark.createDataFrame([(1, 0, 0, "m0", (6, 0, 4, 4)), (1, 0, 1, "m1", (100, 0, 10, 10)), (1, 0, 2, "m2", (102, 0, 10, 10))], schema.format("ordinal"))
    got = {r.text: list(r.marks) for r in spatial.annotate(b, m).collect()}
    assert got == {"a": [0], "b": [], "m1": [2]}


def test_confirmed(spark, sf_dir, blocks):
    found = {(r.doc_id, r.line_no) for r in QUERIES["near_duplicate_blocks"](spark, sf_dir).collect()}
    from folioquarry.functions.text import canonical_key

    keyed = blocks.select("doc_id", "page_index", "line_no", "box", canonical_key(F.col("text")).alias("k"), canonical_key(F.regexp_replace("text", " [^ ]*$", "")).alias("o")).collect()
    expected = set()
    for rows in pages_of(keyed, "doc_id", "page_index").values():
        for a in rows:
            for b in rows:
                moved = b.box.__class__(x=b.box.x + 4, y=b.box.y + 1, w=b.box.w, h=b.box.h)
                if a.k and b.o and overlap(a.box, moved) >= 0.05:
                    part = (len(a.k) >= 12 and a.k in b.o) or (len(b.o) >= 12 and b.o in a.k) or a.k == b.o
                    if part or difflib.SequenceMatcher(None, a.k, b.o).ratio() >= 0.62:
                        expected.add((a.doc_id, a.line_no))
    assert found == expected


def test_fill_cells_gives_a_block_to_one_cell(spark):
    box = "box struct<x: int, y: int, w: int, h: int>"
    cells = spark.createDataFrame([(1, 0, 0, (0, 0, 100, 100)), (1, 0, 1, (0, 0, 50, 50))], f"doc_id long, page_index int, cell_no int, {box}")
    blocks = spark.createDataFrame(
        [(1, 0, 0, "low", (0, 20, 4, 4), 0.5), (1, 0, 1, "high", (0, 2, 4, 4), None), (1, 0, 2, " ", (0, 0, 4, 4), 0.1), (1, 0, 3, "out", (500, 0, 4, 4), 0.1)],
        f"doc_id long, page_index int, line_no int, text string, {box}, confidence double",
    )
    assert [tuple(r) for r in spatial.fill_cells(cells, blocks).select("cell_no", "text", "n_blocks", "confidence").collect()] == [(0, "high\nlow", 2, 0.5)]


def test_operator_rows_and_errors(spark):
    docs = spark.createDataFrame([(1, "Ａ b"), (2, None), (3, " ")], "doc_id long, text string")
    pages = extract.extract(docs).collect()
    assert {(r.doc_id, r.error.code if r.error else None) for r in pages} == {(1, None), (2, "EMPTY_DOCUMENT"), (3, "EMPTY_DOCUMENT")}
    results = {r.doc_id: r.success for r in extract.file_results(extract.extract(docs), docs).collect()}
    assert results == {1: True, 2: False, 3: False}
    with pytest.raises(KeyError):
        base.get_operator("no such operator")
    with pytest.raises(base.OperatorError):
        base.get_operator("uppercase")().transform(docs.select("doc_id"))


class BatchBytes(base.ArrowOperator):
    output = "bytes bigint"

    def process_batch(self, context, batch):
        import pyarrow as pa

        return pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})


def test_operators_get_batches_of_bounded_bytes(spark):
    """what a worker holds follows neither the number of rows nor their lengths."""
    rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    assert max(r.bytes for r in BatchBytes().transform(rows).collect()) <= 2 * (4 << 20)


def test_rows_out_leave_in_parts(spark):
    """all rows, in order, that operators give for a row, however many."""
    rows = spark.createDataFrame([(1, "\n".join(f"l{i}" for i in range(40 * (2 * base.ROWS_OUT + 3)))), (2, " ")], "doc_id bigint, text string")
    found = extract.extract(rows.coalesce(1)).collect()
    assert [r.page_index for r in found if r.doc_id == 1] == list(range(2 * base.ROWS_OUT + 3)) and [r.error.code for r in found if r.doc_id == 2] == ["EMPTY_DOCUMENT"]


def test_deadlines_types_and_hooks(spark, tmp_path):
    import time

    class Noted(base.Hooks):
        def __init__(self, path):
            self.path = path

        def ended(self, context, rows):
            (self.path / f"ended-{rows}-{context.run_id}").touch()

        def failed(self, context, error):
            (self.path / f"failed-{error.code}").touch()

    class Slow(base.RowOperator):
        input_columns, input_types, output, timeout_seconds = ("n",), "n bigint", "n bigint", 0.2

        def __init__(self, path, seconds=5):
            self.hooks, self.seconds = Noted(path), seconds

        def process_row(self, context, row):
            time.sleep(self.seconds if row["n"] else 0)
            return row

    rows = spark.range(2).toDF("n").coalesce(1)
    got = {r.n: r.error.code if r.error else None for r in Slow.from_config({"path": tmp_path}).transform(rows, base.Context(run_id="r"), errors=True).collect()}
    assert got == {0: None, 1: "TIMEOUT"}
    assert {p.name for p in tmp_path.iterdir()} == {"ended-2-r", "failed-TIMEOUT"}
    with pytest.raises(base.OperatorError, match="n must be bigint"):
        Slow(tmp_path).transform(rows.selectExpr("CAST(n AS INT) AS n"))
    with pytest.raises(base.OperatorError, match="Slow"):
        Slow.from_config({"other": 1})
    assert (Slow.works_by(), base.get_operator("uppercase").works_by()) == ("row", "batch")
    batches = list(base.arrow_batches(({"n": i} for i in range(5)), "n bigint", 2))
    assert [b.num_rows for b in batches] == [2, 2, 1] and [r["n"] for r in base.rows_of(batches)] == list(range(5))


def test_retry(spark, tmp_path):
    class Flaky(base.RowOperator):
        input_columns, output, retry = ("n",), "n bigint, tries bigint", base.Retry(attempts=3, wait_seconds=0.0)
        tries = 0

        def process_row(self, context, row):
            self.tries += 1
            if self.tries % 3:
                raise base.OperatorError("again", retryable=True)
            return [{"n": row["n"], "tries": self.tries}, {"n": -row["n"], "tries": self.tries}]

    got = Flaky().transform(spark.range(1, 2).toDF("n").coalesce(1)).collect()
    assert [tuple(r) for r in got] == [(1, 3), (-1, 3)]


def test_contract_checks(spark):
    df = spark.createDataFrame([(1, "file:///x", None), (2, None, None), (3, " ", "{}")], "id int, uri string, inline string")
    checks = {"V1": S.one_payload(F.col("uri"), F.col("inline"))}
    assert {r.id: r.violations for r in S.violations(df, checks).collect()} == {1: [], 2: ["V1"], 3: []}
    with pytest.raises(Exception, match="violated: V1"):
        S.enforce(df, checks).collect()
    with pytest.raises(ValueError, match="lacks"):
        S.conform(df.withColumn("other", F.lit(1)), "id int")
    assert S.conform(df.select("id"), "id int, uri string").columns == ["id", "uri"]


def test_scan_takes_one_of_each_path(spark, tmp_path):
    for name in ("a.pdf", "A.PDF", "sub/b.png", "notes.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    found = [r.path.rsplit("/", 1)[-1] for r in files.scan(spark, str(tmp_path)).orderBy("path").collect()]
    assert sorted(f.lower() for f in found) == ["a.pdf", "b.png"]
    assert files.scan(spark, str(tmp_path), limit=1).count() == 1


def test_reports(spark):
    results = spark.createDataFrame([(True, False, 3, 1, 2.0), (False, False, 9, 9, 1.0), (True, True, 0, 2, 0.5)], "success boolean, skipped boolean, pages int, matches int, elapsed double")
    r = report.batch_report(results).first()
    assert (r.total_files, r.success_count, r.failure_count, r.skipped_count, r.total_pages, r.total_matches, r.seconds_per_page) == (3, 2, 1, 1, 3, 3, 1.167)
    devices = spark.createDataFrame([(0, "GPU-a", 5), (1, "GPU-b", 9)], "index int, uuid string, free_mib int")
    assert [(r["index"], r["visible_index"]) for r in report.visible(devices, "gpu-B,0").orderBy("visible_index").collect()] == [(1, 0), (0, 1)]


def test_bad_json_raises_its_code(spark):
    rows = J.parsed(spark.createDataFrame([('{"no": "list"}',)], "json string"))
    with pytest.raises(Exception, match="INVALID_CONTENT_LIST"):
        J.flat_blocks(rows).collect()


def test_tables_merge(spark, sf_dir):
    got = QUERIES["merged_artifact_text"](spark, sf_dir)
    assert {r.origin for r in got.select("origin").distinct().collect()} <= {"kept", "replaced", "appended"}
    box = F.struct("x", "y", "w", "h")
    again = got.where("text <> ''").select("doc_id", "page_index", "line_no", "text", box.alias("box"))
    assert tables.new_blocks(again, again).isEmpty()


def test_chunks_number_all_rows(spark):
    rows = spark.range(0, 1000, 1, 7).withColumn("k", (F.col("id") * 37) % 1000)
    got = {r.k: r.chunk for r in report.chunks(rows, ["k"], 64).collect()}
    assert got == {k: k // 64 for k in range(1000)}


def test_batch_rows_have_the_fixed_columns(spark):
    results = spark.createDataFrame([("a.pdf", True, ["x", "y"], 3)], "pdf_path string, success boolean, field_keywords array<string>, other int")
    row = report.batch_rows(results).first().asDict()
    assert tuple(row) == report.BATCH_COLUMNS and len(row) == 27
    assert (row["pdf_path"], row["success"], row["field_keywords"], row["error"]) == ("a.pdf", "true", '["x","y"]', None)


def test_normalised_texts(spark):
    docs = spark.createDataFrame([(1, "*  Ａ１\u3000b\u200b\r\nc ~"), (2, None), (3, "")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in base.get_operator("normalize_text")().transform(docs).collect()} == {1: " A1 b c ", 2: "", 3: ""}


def wrapped_by_force(cells, targets):
    """Cells (text, box) and html targets, by plain search."""
    def follows(a, b):
        (ax, ay, aw, ah), (bx, by, bw, bh) = a, b
        share = lambda p, q, r, s: max(0, min(p + q, r + s) - max(p, r)) / max(1, min(q, s))
        reach, gap, down = max(48, ah * 2.5, bh * 2.5), bx - ax - aw, max(0, by - ay - ah)
        beside = share(ay, ah, by, bh) >= 0.45 and -max(6, min(aw, bw) * 0.5) <= gap <= reach
        near = share(ax, aw, bx, bw) >= 0.35 or abs(bx + bw / 2 - ax - aw / 2) <= max(48, aw * 2.5, bw * 2.5)
        return beside or (by >= ay - max(4, ah * 0.25) and down <= reach and near)

    texts, used, out = {t for t, _ in cells}, set(), {}
    for target in targets:
        if len(target) < 4 or target in texts:
            continue
        for start, (text, _) in enumerate(cells):
            if start in used or not text or text == target or not target.startswith(text):
                continue
            walk, read = [start], text
            while read != target:
                here = cells[walk[-1]][1]
                options = [
                    (max(0, b[1] - here[1] - here[3]), abs(b[0] + b[2] / 2 - here[0] - here[2] / 2), i) for i, (t, b) in enumerate(cells)
                    if i not in used and i not in walk and t and target[len(read) :].startswith(t) and follows(here, b)
                ]
                if not options:
                    break
                walk.append(min(options)[2])
                read += cells[walk[-1]][0]
            if read == target:
                out[walk[0]] = (target, walk)
                used.update(walk)
                break
    gone = {i for _, walk in out.values() for i in walk[1:]}
    return {i: (out[i][0] if i in out else t) for i, (t, _) in enumerate(cells) if i not in gone}


def test_wrapped_cells_by_force(spark):
    import random

    r = random.Random(12)
    cells, html, expected = [], [], {}
    for table in range(60):
        pieces = [("".join(r.choice("ab") for _ in range(r.randint(0, 3))), (r.randint(0, 200), r.randint(0, 120), r.randint(10, 60), r.randint(8, 20))) for _ in range(r.randint(1, 12))]
        targets = ["".join(r.choice("ab") for _ in range(r.randint(2, 7))) for _ in range(6)] + ["".join(t for t, _ in r.sample(pieces, min(len(pieces), 3))) for _ in range(3)]
        targets = list(dict.fromkeys(t for t in targets if t))
        cells += [(table, 0, 0, n, t, box, n // 3, n % 3) for n, (t, box) in enumerate(pieces)]
        html.append((table, 0, 0, "<table><tr>" + "".join(f"<td>{t}</td>" for t in targets) + "</tr></table>"))
        expected[table] = wrapped_by_force(pieces, targets)
    keys, box = "doc_id long, page_index int, table_no int", "box struct<x: int, y: int, w: int, h: int>"
    got = tables.merge_wrapped(
        spark.createDataFrame(cells, f"{keys}, cell_no int, text string, {box}, row_index int, col_index int").repartition(3), spark.createDataFrame(html, f"{keys}, html string")
    ).collect()
    assert {t: {r.cell_no: r.text for r in got if r.doc_id == t} for t in expected} == expected
    assert any(r.merged for r in got)


def test_wrapped_cells_of_split_texts(spark):
    """Texts over two lines and over a grid of four, as recognisers split them; a space between ideographs in the html does not matter."""
    rows = [("入", (79, 167, 19, 18)), ("党", (104, 166, 19, 21)), ("参加工", (194, 166, 45, 18)), ("1995.05", (137, 175, 47, 16)), ("1995.07", (251, 175, 47, 15)), ("时", (78, 181, 30, 20)), ("间", (103, 181, 19, 19)), ("作时间", (194, 181, 45, 20))]
    keys, box = "doc_id long, page_index int, table_no int", "box struct<x: int, y: int, w: int, h: int>"
    cells = spark.createDataFrame([(1, 0, 0, n, t, b, n // 5, n % 5) for n, (t, b) in enumerate(rows)], f"{keys}, cell_no int, text string, {box}, row_index int, col_index int")
    html = spark.createDataFrame([(1, 0, 0, "<table><tr><td>入 党 时 间</td><td>1995.05</td><td>参加工 作时间</td><td>1995.07</td></tr></table>")], f"{keys}, html string")
    got = {r.text: (r.merged, tuple(r.box), r.row_index, r.col_index) for r in tables.merge_wrapped(cells, html).collect()}
    assert got == {"入党时间": (True, (78, 166, 45, 35), 0, 0), "参加工作时间": (True, (194, 166, 45, 35), 0, 2), "1995.05": (False, (137, 175, 47, 16), 0, 3), "1995.07": (False, (251, 175, 47, 15), 0, 4)}


def test_merged_texts_page_by_page(spark):
    """Replacement of the one like block, several like blocks, joined blocks, texts already said, whole-page texts, and texts appended before."""
    from folioquarry.operators.fusion import merge_artifact_text

    box = "box struct<x: int, y: int, w: int, h: int>"
    at = lambda y: (0, y, 100, 20)
    blocks = [
        (1, 0, 0, "The quick brown fox jmps", at(0), 0.7, "text"), (1, 0, 1, "Twice the same words here", at(100), 0.7, "text"), (1, 0, 2, "Twice the same words hero", at(102), 0.7, "text"),
        (1, 0, 3, "left half of it", at(200), 0.7, "text"), (1, 0, 4, "right half of it", (0, 210, 100, 20), 0.7, "text"), (1, 0, 5, "A cell text", at(300), 0.5, "table_cell"), (2, 0, 0, " untouched ", at(0), None, "text"),
    ]
    texts = [
        (1, 0, 0, "The quick brown fox jumps", at(1), 0.9, False), (1, 0, 1, "Twice the same words herd", at(101), 0.99, False), (1, 0, 2, "left half of it right half of it", (0, 200, 100, 30), 0.9, False),
        (1, 0, 3, "A cell texts", at(300), 0.99, False), (1, 0, 4, "Entirely new words", at(500), 0.9, False), (1, 0, 5, "entirely new words!", at(700), 0.9, False), (1, 0, 6, "Only from the whole page", at(800), 0.9, True), (3, 0, 0, "no blocks", at(0), None, False),
    ]
    got = merge_artifact_text(
        spark.createDataFrame(blocks, f"doc_id long, page_index int, line_no int, text string, {box}, confidence double, block_type string"),
        spark.createDataFrame(texts, f"doc_id long, page_index int, ordinal int, text string, {box}, confidence double, whole_page boolean"),
    ).collect()
    said = {(r.doc_id, r.line_no): (r.text, r.origin, r.original_text, r.box.y, r.confidence) for r in got}
    assert said[1, 0] == ("The quick brown fox jumps", "replaced", "The quick brown fox jmps", 1, 0.9)
    assert {k: v[0] for k, v in said.items() if v[1] == "kept"} == {(1, n): blocks[n][3] for n in range(1, 6)} | {(2, 0): " untouched "}
    assert {k: v[0] for k, v in said.items() if v[1] == "appended"} == {(1, -5): "Entirely new words", (3, -1): "no blocks"}


def test_search_stream_equals_batch(spark, sf_dir, tmp_path):
    from folioquarry.operators import search
    from folioquarry.plans import field_search_plan
    from folioquarry.streaming import arrivals, search_stream

    docs = L.read_documents(spark, sf_dir).select("doc_id", "text")
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    words = search.keyword_table(spark, ["the", "und"])
    q = search_stream(arrivals(spark, str(tmp_path / "in"), docs.schema, 1), words, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).select("doc_id", "keyword", "page_index", "text", "source")
    batch = field_search_plan(spark, docs, ["the", "und"]).select("doc_id", "keyword", "page_index", "text", "source")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_ocr_correction_of_whole_texts(spark, tmp_path):
    """The registered query, against plain Python."""
    texts = ["short", None, "", "x" * 30 + " 签字(盖率) 粤府办[2020] 5号 " + "y " * 4000 + "（盖率） 某函（2021）7号 end", "one\ntwo " * 10 + "签字盖率\nlast line"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))

    def plain(i, text):
        text = f"{text} 签字(盖率) 签字盖率 粤府办[{2000 + i % 25}] {i}号 某函(2021)7号"
        for wrong, right in (("（盖率）", "（盖章）"), ("(盖率)", "(盖章)"), ("签字盖率", "签字盖章")):
            text = text.replace(wrong, right)
        text = re.sub(r"([一-鿿A-Za-z]{1,20})[\[〔](\d{4})[\]〕](\s*\d+\s*号)", r"\1〔\2〕\3", text)
        return re.sub(r"([一-鿿A-Za-z]{1,20}(?:监办|府办|办发|府发|函|字|文))[（(](\d{4})[）)](\s*\d+\s*号)", r"\1〔\2〕\3", text)

    got = {r.doc_id: r.corrected for r in QUERIES["ocr_correction"](spark, str(tmp_path)).collect()}
    assert got == {i: None if t is None else plain(i, t) for i, t in enumerate(texts)}


def test_nested_layout_to_any_depth(spark):
    """Captions, footnotes, spans without lines, blocks below lines, html under any key, and blocks deeper than three."""
    deep = {"spans": [{"content": "bottom"}], "other": {"html": " <b>deep</b> "}}
    for _ in range(40):
        deep = {"blocks": [deep]}
    blocks = [
        {"bbox": [0, 0, 5, 5], "image_caption": [{"content": "caption"}], "image_footnote": {"text": "foot"}},
        {"bbox": [0, 0, 5, 5], "text": "later", "content": " first ", "lines": [{"blocks": [{"text": "in line"}]}], "spans": [{"text": "direct"}]},
        {"type": "table", "bbox": [0, 0, 5, 5], "table_footnote": [{"text": "note"}], "table_caption": [{"text": "title"}], "blocks": [deep]},
        {"type": "table", "bbox": [0, 0, 5, 5], "zzz": [{"html": "<i>1</i>"}], "blocks": [{"html": "<i>2</i>"}], "content": " ", "text": "unread"},
        "no block",
    ]
    rows = spark.createDataFrame([(json.dumps({"pdf_info": [{"para_blocks": blocks}, {"preproc_blocks": []}]}),)], "json string")
    pages = J.nested_pages(rows)
    assert [r.text for r in J.page_text_blocks(pages).orderBy("ordinal").collect()] == ["caption\nfoot", "first\nin line\ndirect", "bottom\ntitle\nnote"]
    assert [r.html for r in J.page_tables(pages).orderBy("table_index").collect()] == ["<b>deep</b>", "<i>1</i>"]
    assert [r.text for r in J.page_text_blocks(J.nested_pages(J.parsed(rows))).orderBy("ordinal").collect()][2] == "bottom\ntitle\nnote"


def test_pages_take_what_is_below_their_own_blocks(spark):
    """the JSON is parsed once, and pages without blocks, or documents without pages, stay what they were."""
    text = '{"pdf_info":[{"para_blocks":[{"type":"text","bbox":[0,0,2,2],"text":"a"}]},{},{"preproc_blocks":[{"type":"text","bbox":[0,0,3,3],"text":"b"},{"bbox":[1,1,2,2],"text":"c"}]}]}'
    pages = J.nested_pages(spark.createDataFrame([(1, text), (2, '{"pdf_info":[]}')], "doc_id int, json string"))
    plan = pages._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("pdf_info") == 1
    assert [(r.doc_id, r.position, [b.texts for b in r.below]) for r in pages.orderBy("position").collect()] == [(1, 0, [["a"]]), (1, 1, []), (1, 2, [["b"], ["c"]])]
    assert sorted((r.position, r.ordinal, r.text) for r in J.page_text_blocks(pages).collect()) == [(0, 0, "a"), (2, 0, "b"), (2, 1, "c")]


def test_tiles_give_the_pairs_of_pages(spark):
    """Boxes of all sizes, on tile borders, without extent, beyond the page: the same rows with tiles as without."""
    import random

    r = random.Random(3)
    side = lambda: r.choice([0, 1, 5, 63, 64, 65, 130, 600, 5000, 90_000])
    place = lambda: r.choice([-100, 0, 63, 64, 128, 512, r.randint(0, 3000), r.randint(0, 50_000)])
    kind = "doc_id long, page_index int, line_no int, text string, confidence double, box struct<x: int, y: int, w: int, h: int>"
    rows = [(i % 3, i % 2, i, f"t{i}" if i % 7 else " ", 0.5, (place(), place(), side(), side()) if i % 11 else None) for i in range(160)]
    blocks = spark.createDataFrame(rows, kind)
    regions = spark.createDataFrame([(d, p, n, t, c, (place(), place(), side(), side())) for d, p, n, t, c, _ in rows[:60]], kind).withColumnRenamed("line_no", "ordinal")
    out = lambda df: sorted(map(str, df.collect()))
    assert out(spatial.outside(blocks, regions, crowded=True)) == out(spatial.outside(blocks, regions))
    blocks = blocks.where("box IS NOT NULL")
    for test in (G.touching, G.center_inside, lambda a, b: G.overlap(a, b) >= 0.2):
        plain = spatial.pairs(blocks, regions, test).select("l.line_no", "r.ordinal")
        assert out(spatial.by_tile(blocks, regions, test).select("l.line_no", "r.ordinal")) == out(plain) and plain.count() > 20
    near = lambda a, b: G.center_inside(a, b) | (F.abs(a["x"] - b["x"]) + F.abs(a["y"] - b["y"]) <= 40)
    assert out(spatial.first_match(blocks, regions, near, crowded=True, reach=41)) == out(spatial.first_match(blocks, regions, near))
    cells = regions.withColumnRenamed("ordinal", "cell_no")
    assert out(spatial.fill_cells(cells, blocks, crowded=True)) == out(spatial.fill_cells(cells, blocks))


def test_a_crowded_page(spark):
    """A page of 10,000 boxes: pairs by tiles, and reading order, in time that grows with the boxes."""
    grid = spark.range(10_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(0).alias("page_index"), F.col("id").cast("int").alias("line_no"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
        F.struct((F.col("id") % 50 * 50).cast("int").alias("x"), (F.floor(F.col("id") / 50) * 30).cast("int").alias("y"), F.lit(40).alias("w"), F.lit(20).alias("h")).alias("box"))
    cells = grid.where("line_no % 4 = 0").withColumnRenamed("line_no", "ordinal")
    found = spatial.first_match(grid, cells, G.center_inside, crowded=True)
    assert found.count() == 2_500 and found.where("line_no <> region").isEmpty()
    ordered = reading.reading_order(grid)
    assert ordered.count() == 10_000 and ordered.agg(F.max("line")).first()[0] == 199 and ordered.where("place <> 50 * line + cast(x / 50 as int)").isEmpty()


def test_benchmark_state_is_whole_or_not(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    trials = spark.createDataFrame([("ocr", 1, 2.0)], "engine string, n int, elapsed double")
    report.save_state(trials, path)
    report.save_state(trials.withColumn("n", F.lit(2)), path)
    trials.withColumn("n", F.lit(3)).write.parquet(f"{path}/broken")  # a run that ended before its rename
    assert report.load_state(spark, path).first().n == 2


def test_parsers_with_a_schema_of_their_own(spark):
    def words(text, options):
        return [{"page_index": i, "word": w, "n": options["n"]} for i, w in enumerate(text.split())]

    extract.register_parser("words_of_test", words, "doc_id bigint, page_index int, word string, n int")
    rows = extract.extract(spark.createDataFrame([(1, "a b"), (2, " ")], "doc_id long, text string"), "words_of_test", {"n": 5}).collect()
    assert sorted((r.doc_id, r.word, r.n, r.error and r.error.code) for r in rows if r.word) == [(1, "a", 5, None), (1, "b", 5, None)]
    assert [r.error.code for r in rows if r.error] == ["EMPTY_DOCUMENT"]
    for bad in (lambda: extract.register_parser("x", words, "a int"), lambda: extract.ExtractPages("nowhere"), lambda: extract.extract(spark.range(1).selectExpr("id AS doc_id", "'' AS text"), partitions=0)):
        with pytest.raises(base.OperatorError):
            bad()
