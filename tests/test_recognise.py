"""Recognition by pluggable readers, picture facts, and whole runs that resume."""

import struct

import pytest
from pyspark.sql import functions as F

from folioquarry import plans
from folioquarry.operators import recognise as R
from folioquarry.sources import files, layout_text as L, pictures

KEYS = ("doc_id", "page_index", "item_no")
BOX = "box struct<x: int, y: int, w: int, h: int>"


class Sizes(R.TextReader):
    """Tells how many items and bytes it was given at once."""

    def read(self, items):
        if len(items) > 1 and any(b"bad" in bytes(i["content"]) for i in items):
            raise OSError("a batch with a bad item")
        return [[t | {"raw": f"{len(items)} {sum(len(i['content']) for i in items)}"} for t in found] for found in super().read(items)]


def items(spark, texts):
    return spark.createDataFrame([(i, 0, 0, None, f"<td>{'</td><td>'.join('x' * n)}</td>", t if t is None else t.encode()) for i, (t, n) in enumerate(texts)], f"doc_id long, page_index int, item_no int, {BOX}, html string, content binary")


def test_one_row_for_a_bad_item_and_bounded_batches(spark, monkeypatch):
    given = items(spark, [("a | b", 2), ("bad | x", 2), ("c | d", 2), ("no table", 0)] + [("e | " + "f" * 5000, 2)] * 4).coalesce(1)
    found = R.recognise(given, Sizes(refuses="bad"), *KEYS).collect()
    assert [r.doc_id for r in found if r.error] == [1] and found[0].cells[1].text == "b" and {r.doc_id for r in found} == {0, 1, 2, 4, 5, 6, 7}
    assert next(r for r in found if r.error).error.code == "READ_FAILED"
    monkeypatch.setattr(R, "BATCH_BYTES", 6000)
    batches = list(R._batches_of([{"content": b"x" * n} for n in (5000, 900, 200, 7000, 1)]))
    assert [[len(i["content"]) for i in b] for b in batches] == [[5000, 900], [200], [7000], [1]]


def test_second_pass_reads_failed_and_poor_items_only(spark):
    given = items(spark, [("a | b", 2), ("a | b | c", 3), ("bad | x", 2), ("c", 0)])
    found = R.two_passes(given, R.TextReader(loses=1, refuses="bad", provider="one"), R.TextReader(provider="two"), *KEYS)
    got = {r.doc_id: (len(r.cells), r.fallback, r.error is None) for r in found.collect()}
    assert got == {0: (2, True, True), 1: (3, True, True), 2: (2, True, True)}
    both_bad = R.two_passes(given, R.TextReader(refuses="bad"), R.TextReader(refuses="bad"), *KEYS)
    got = {r.doc_id: (r.fallback, r.error is None) for r in both_bad.collect()}
    assert got == {0: (False, True), 1: (False, True), 2: (False, False)}


@pytest.mark.parametrize("fail_open", [True, False])
def test_outcomes_by_document(spark, fail_open):
    docs = spark.createDataFrame([(1, None), (2, "mineru_crops"), (3, "mineru_crops"), (4, "ppstructurev3"), (5, "ppstructurev3"), (6, "OCR")], "doc_id long, mode string")
    blocks = spark.createDataFrame([(d, 0, n, t, (10, 20 * n, 100, 16)) for d in range(1, 7) for n, t in enumerate(["a | b", "prose"])], f"doc_id long, page_index int, line_no int, text string, {BOX}")
    crops = [(1, 0, 0, (0, 0, 200, 18), "<td>", b"a | b"), (2, 0, 0, (0, 0, 200, 18), None, b"bad"), (4, 0, 0, (0, 0, 200, 18), None, None)]
    candidates = spark.createDataFrame(crops, f"doc_id long, page_index int, candidate_no int, {BOX}, html string, content binary")
    pages = spark.createDataFrame([(d, 0, b"a | b\nprose") for d in range(1, 7)], "doc_id long, page_index int, content binary")
    refined = R.refine(docs, blocks, candidates, pages, R.Options(fail_open=fail_open), R.TextReader(refuses="bad", provider="crops"), R.TextReader(provider="pages"))
    got = {r.doc_id: (r.mode, r.outcome, r.error and r.error.code) for r in refined.outcomes.collect()}
    bad = "warned" if fail_open else "failed"
    assert got == {
        1: ("table_structure", "merged", None), 2: ("table_structure", bad, "READ_FAILED"), 3: ("table_structure", "skipped", None),
        4: ("ppstructurev3", "merged", None), 5: ("ppstructurev3", "skipped", None), 6: ("ppstructurev3", "merged", None),
    }
    assert {(r.doc_id, r.provider) for r in refined.tables.collect()} == {(1, "crops"), (4, "pages"), (6, "pages")}
    texts = {}
    for r in refined.blocks.collect():
        texts.setdefault(r.doc_id, set()).add((r.kind, r.text))
    assert texts[1] == {(0, "prose"), (2, "a"), (2, "b")} and texts[2] == texts[3] == texts[5] == {(0, "a | b"), (0, "prose")}
    assert {r.doc_id for r in R.artifact(refined).collect()} == {1, 4, 6}
    with pytest.raises(ValueError, match="UNSUPPORTED"):
        R.refine(docs, blocks, candidates, pages, R.Options(provider="other"), R.TextReader(), R.TextReader())
    off = R.refine(docs, blocks, candidates, pages, R.Options(enabled=False), R.TextReader(), R.TextReader())
    assert {r.outcome for r in off.outcomes.collect()} == {"off"} and off.tables.count() == 0


def jpeg(w, h, progressive=False):
    app = b"\xff\xe0" + struct.pack(">H", 20) + b"\xff\xc0" * 9
    return b"\xff\xd8" + app + b"\xff\xff\xdb\x00\x04\x00\x00" + (b"\xff\xc2" if progressive else b"\xff\xc0") + struct.pack(">HBHH", 11, 8, h, w) + b"\x01\x01\x11\x00"


def tiff(order, w, h, at=8):
    entry = lambda tag, kind, v: struct.pack(order + "HHI", tag, kind, 1) + (struct.pack(order + "HH", v, 0) if kind == 3 else struct.pack(order + "I", v))
    return (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, at) + b"\0" * (at - 8) + struct.pack(order + "H", 3) + entry(254, 4, 0) + entry(256, 3, w) + entry(257, 4, h)


def test_picture_sizes_from_bytes(spark, tmp_path):
    made = {
        "a.png": (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 70_000, 3), ("png", 70_000, 3)), "b.JPG": (jpeg(640, 480), ("jpeg", 640, 480)), "c.jpeg": (jpeg(7, 65_535, True), ("jpeg", 7, 65_535)),
        "d.bmp": (b"BM" + b"\0" * 16 + struct.pack("<ii", 10, -20), ("bmp", 10, 20)), "e.tif": (tiff("<", 11, 12), ("tiff", 11, 12)), "f.tiff": (tiff(">", 65_000, 13, 40), ("tiff", 65_000, 13)),
        "g.gif": (b"GIF89a" + struct.pack("<HH", 300, 2), ("gif", 300, 2)), "h.webp": (b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + (299).to_bytes(3, "little") + (99).to_bytes(3, "little"), ("webp", 300, 100)),
        "i.png": (b"\x89PNG\r\n\x1a\n", ("png", None, None)), "j.jpg": (b"\xff\xd8\xff\xe0\0\x10", ("jpeg", None, None)), "k.png": (b"no", (None, None, None)), "n.png": (b"", None), "l.tif": (b"II*\0\xff\0\0\0", ("tiff", None, None)), "m.txt": (b"no", None),
    }
    (tmp_path / "deep").mkdir()
    for i, (name, (data, _)) in enumerate(made.items()):
        (tmp_path / ("deep" if i % 2 else ".") / name).write_bytes(data)
    got = {r.path.rsplit("/", 1)[1]: (r.kind, r.width, r.height) for r in pictures.scan(spark, f"file://{tmp_path}").collect()}
    assert got == {name: facts for name, (_, facts) in made.items() if facts}


def test_runs_resume(spark, tmp_path, sf_dir):
    """What a broken run wrote is not read; the next run works what is not committed, once."""
    docs = L.read_documents(spark, sf_dir).where("doc_id < 40").select("doc_id", F.when(F.col("doc_id") == 3, " ").otherwise(F.col("text")).alias("text"))
    path, calls = f"file://{tmp_path}/run", []

    def breaking(part):
        calls.append([r.doc_id for r in part.collect()])
        if len(calls) == 3:
            plans.document_results_plan(part).write.parquet(f"{path}/results/round=broken")  # written, and then the run ends
            raise RuntimeError("lost")
        return plans.document_results_plan(part)

    with pytest.raises(RuntimeError):
        plans.run_documents(docs, path, breaking, rounds=4)
    assert plans.read_results(spark, path).count() == sum(map(len, calls[:2]))
    plans.run_documents(docs, path, breaking, rounds=4)
    assert sorted(x for c in [*calls[:2], *calls[3:]] for x in c) == [r.doc_id for r in docs.orderBy("doc_id").collect()]
    done = {r.doc_id: r for r in plans.read_results(spark, path).collect()}
    assert len(done) == docs.count() and done[3].error_code == "EMPTY_DOCUMENT" and done[3].result is None
    assert all(r.markdown.endswith("\n") and r.page_count > 0 for r in done.values() if r.doc_id != 3)
    assert plans.run_documents(docs, path, breaking, rounds=4) == []


def test_whole_documents_by_force(spark, sf_dir):
    """Pages, blocks, cells and matches of single documents, counted by hand."""
    docs = L.read_documents(spark, sf_dir).where("text IS NOT NULL AND doc_id < 60").select("doc_id", "text")
    from folioquarry.operators.search import keyword_table

    got = plans.document_results_plan(docs, keyword_table(spark, ["the"]), cells=L.cells(docs), tables_=L.tables(docs)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    boxes = {}
    for t in L.tables(docs).collect():
        boxes[t.doc_id, t.page_index] = t.box
    for r in got:
        lines = texts[r.doc_id].split("\n")
        cells = [c for x in lines if " | " in x and x.strip() for c in x.split(" | ") if c.strip()]
        assert r.page_count == -(-len(lines) // 40) and r.cell_count == len(cells)
        if not any(d == r.doc_id for d, _ in boxes):
            assert r.block_count == sum(bool(x.strip()) for x in lines)
    assert {r.doc_id for r in got} == set(texts)


def test_files_are_found_by_their_exact_names(spark):
    listed = ["in/007.pdf", "in/7.pdf", "in/deep/008.png", "in/deep/008.pdf", "in/009.docx", "in/010.PDF", "in/a.b.pdf", "in/deep/x.tif", "in/deep-er/011.jpg", "in/deep/011.jpg", "in/deep/012.pdf", "in/012.png"]
    rows = spark.createDataFrame([(p,) for p in listed], "path string")
    wanted = ["007", "7", "008", "009", "010", "x.tif", "7.png", "a", "011", "012", "013", None]
    asked = spark.createDataFrame([(w,) for w in wanted], "file_no string")
    got = {r.file_no: r.path for r in files.find_inputs(asked, rows, "in").collect()}
    assert got == {"007": "in/007.pdf", "7": "in/7.pdf", "008": "in/deep/008.pdf", "009": "in/009.docx", "010": "in/010.PDF", "x.tif": "in/deep/x.tif", "7.png": None, "a": "in/a.b.pdf", "011": "in/deep/011.jpg", "012": "in/012.png", "013": None, None: None}


def test_sheet_values(spark):
    import datetime

    sheet = spark.createDataFrame([("7", datetime.date(2024, 2, 3), datetime.datetime(2024, 2, 3), 12.0, " a  b "), ("8", None, datetime.datetime(2024, 2, 3, 4, 5, 6), 1.5, None)], "no string, k1 date, k2 timestamp, k3 double, k4 string")
    got = {r.file_no: r.keywords for r in files.keyword_rows(sheet, "no", "k").collect()}
    assert got == {"007": ["2024-02-03", "2024-02-03", "12", "a b"], "008": ["2024-02-03 04:05:06", "1.5"]}


def test_rows_without_a_number_in_a_table(spark):
    from folioquarry.operators import refine

    rows = [(1, 0, None, 0, "first", (0, 0, 9, 9)), (1, 0, None, 0, "second", (0, 50, 9, 9)), (1, 0, 1, 1, "of row one", (0, 40, 9, 9)), (1, 0, None, 0, " ", (0, 10, 9, 9)), (1, 0, 5, 0, "last", (0, 99, 9, 9))]
    cells = spark.createDataFrame(rows, f"doc_id long, page_index int, row_index int, col_index int, text string, {BOX}")
    assert refine.table_text_distinct(cells).first().text == "first\nsecond of row one\nlast"


def test_texts_that_the_page_says_are_not_appended(spark):
    from folioquarry.operators.fusion import merge_artifact_text

    kind = f"doc_id long, page_index int, line_no int, text string, {BOX}, confidence double"
    blocks = spark.createDataFrame([(1, 0, 0, "a long text that", (0, 0, 99, 9), 0.9), (1, 0, 1, "goes over two blocks", (0, 10, 99, 9), 0.9)], kind)
    texts = spark.createDataFrame([(1, 0, 0, "long text that goes over", (0, 500, 99, 9), 0.99), (1, 0, 1, "altogether different words", (0, 600, 99, 9), 0.99)], kind.replace("line_no", "ordinal"))
    got = merge_artifact_text(blocks, texts).collect()
    assert sorted(r.text for r in got if r.origin == "appended") == ["altogether different words"]
    page = spark.createDataFrame([(1, 0, "altogether different words")], "doc_id long, page_index int, text string")
    assert not [r for r in merge_artifact_text(blocks, texts, page).collect() if r.text == "altogether different words"]


def test_artifacts_are_written_and_referred_to(spark, tmp_path):
    docs = spark.createDataFrame([(1, None), (2, None)], "doc_id long, mode string")
    blocks = spark.createDataFrame([(d, 0, 0, "a | b", (10, 0, 100, 16)) for d in (1, 2)], f"doc_id long, page_index int, line_no int, text string, {BOX}")
    none = spark.createDataFrame([], f"doc_id long, page_index int, candidate_no int, {BOX}, html string, content binary")
    pages = spark.createDataFrame([(1, 0, b"a | b\nc | d"), (2, 0, b"prose")], "doc_id long, page_index int, content binary")
    refined = R.refine(docs, blocks, none, pages, R.Options(), R.TextReader(), R.TextReader())
    refs = R.write_artifacts(refined, f"file://{tmp_path}/artifacts").collect()
    assert [(r.doc_id, r.kind, r.table_count, r.cell_count, r.uri.endswith("artifacts#1")) for r in refs] == [(1, "paddle_table_json", 1, 4, True)]
