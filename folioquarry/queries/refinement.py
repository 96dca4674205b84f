"""Queries on refinement: fallbacks, html as a source, wire formats, pages from several models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import reading, refine
from ..operators.spatial import PAGE
from ..plans import pages_from_models
from ..sources import layout_json as J
from ..sources import layout_text as L
from ..sources.files import read_table
from .layout import _IN_LINES, _NEAR, _REGIONS, _regions
from .registry import BLANKS, FIXTURES, KEY, ONE, Registry, not_redundant

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql
SIDES = ["box.x", "box.y", "box.w", "box.h"]


def _docs(spark, sf_dir):
    return L.read_documents(spark, sf_dir)


@query(f"""WITH {FIXTURES}, c AS (SELECT doc_id, page_index, min(line_no) AS n FROM blocks GROUP BY 1, 2), t AS (SELECT doc_id, page_index, x, y, w, h FROM tables)
SELECT doc_id, page_index, CAST(coalesce(i, 0) AS INT) AS table_no, 'p' || page_index || '-mineru-t' || coalesce(i, 0) AS table_id, x, y, w, h, i IS NOT NULL AS fallback FROM (
  SELECT t.*, NULL AS i FROM t UNION ALL SELECT b.doc_id, b.page_index, b.x, b.y, b.w, b.h, b.line_no FROM blocks b ANTI JOIN t USING (doc_id, page_index))""")
def table_fallbacks(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    html = F.lit(None).cast("string").alias("html")
    raw = L.tables(docs).select(*PAGE, F.lit(0).alias("table_no"), "box", html)
    candidates = L.blocks(docs).select(*PAGE, F.col("line_no").alias("candidate_no"), "box", html)
    has = L.tables(docs).select(*PAGE).withColumn("has", F.lit(True))
    return refine.table_blocks(raw, candidates).join(has, [*PAGE], "left").select(*PAGE, "table_no", "table_id", *SIDES, F.col("has").isNull().alias("fallback"))


@query("""SELECT l_orderkey, l_linenumber, '| ' || l_returnflag || ' | ' || l_linestatus || ' |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || l_partkey || ' | a\\|b |' AS pipes FROM lineitem""".replace("\\\\", "\\"))
def pipe_tables(spark, sf_dir):
    items = read_table(spark, f"{sf_dir}/lineitem.parquet")
    table = F.concat(
        F.lit("<table><tr><th>"), F.col("l_returnflag"), F.lit("</th><th> "), F.col("l_linestatus"), F.lit("</th></tr><tr></tr>\n<tr><td><b>"), F.col("l_partkey").cast("string"),
        F.lit("</b></td><td>a|b</td></tr></table>"),
    )
    return items.select("l_orderkey", "l_linenumber", refine.pipe_table(table).alias("pipes"))


@query(f"""WITH {FIXTURES}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY row_index, col_index) AS k FROM cells)
SELECT doc_id, page_index, row_index, col_index, CASE WHEN col_index % 2 = 0 THEN 'h' || k ELSE text END AS text, CASE WHEN col_index % 2 = 0 THEN 'mineru_table_html' ELSE 'own' END AS text_source
FROM r WHERE trim(text) <> ''""")
def html_grid_fill(spark, sf_dir):
    """Even columns lose their texts and take those of an html table with as many cells."""
    cells = L.cells(_docs(spark, sf_dir)).where("trim(text) <> ''")
    html = cells.groupBy(*PAGE).agg(F.array_join(F.transform(F.sequence(F.lit(1), F.count("*").cast("int")), lambda k: F.concat(F.lit("<td>h"), k.cast("string"), F.lit("</td>"))), "").alias("html"))
    blanked = cells.select(*PAGE, "row_index", "col_index", F.when(F.col("col_index") % 2 == 0, "").otherwise(F.col("text")).alias("text"))
    return refine.fill_from_html(blanked, html, *PAGE).select(*PAGE, "row_index", "col_index", "text", "text_source")


@query(f"""WITH {FIXTURES} SELECT doc_id, page_index, 'r' || row_index || 'c' || col_index AS table_id, text, x FROM cells""")
def wire_round_trip(spark, sf_dir):
    cells = L.cells(_docs(spark, sf_dir)).select(*PAGE, F.concat(F.lit("r"), F.col("row_index").cast("string"), F.lit("c"), F.col("col_index").cast("string")).alias("table_id"), "text", F.col("box.x").alias("x"))
    return refine.from_wire(refine.to_wire(cells), "table_id: string, text: string, x: int")


@query("""WITH p AS (SELECT doc_id, CAST(doc_id % 4 AS INT) AS n FROM documents), u AS (SELECT doc_id, unnest(range(1, n + 1)) AS k FROM p)
SELECT doc_id, CAST(k - 1 AS INT) AS page_index, CAST(k AS INT) AS page_number, 'out/' || doc_id || '/page-' || lpad(CAST(k AS VARCHAR), 4, '0') || '.png' AS image_path, 'in/' || doc_id || '.pdf' AS source_pdf, 144 AS dpi FROM u""")
def screenshot_manifest(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", (F.col("doc_id") % 4).cast("int").alias("num_pages"), F.concat(F.lit("in/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("file_uri"))
    return refine.screenshot_manifest(docs, "out", 144)


@query("""WITH d AS (SELECT doc_id, lang IS NOT NULL AS enabled, n_chars % 3 AS tables, source LIKE '%a%' AS forced,
  CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ' OCR ' WHEN 2 THEN 'crops' ELSE 'vl' END AS mode, n_chars % 5 > 0 AS needs, n_chars % 7 = 0 AS broken, doc_id % 9 AS p FROM documents),
g AS (SELECT *, enabled AND (coalesce(tables, 0) > 0 OR coalesce(forced, false) OR coalesce(mode, 'auto') <> 'crops' OR NOT coalesce(needs, true)) AS refine FROM d)
SELECT doc_id, refine, CASE WHEN NOT enabled THEN 'off' WHEN NOT refine THEN 'skipped' WHEN p = 0 THEN 'unsupported' WHEN NOT coalesce(broken, false) THEN 'merged' WHEN p % 2 = 0 THEN 'warned' ELSE 'failed' END AS outcome FROM g""")
def refine_gate(spark, sf_dir):
    """F20, C2 on options made of the documents' columns."""
    d = F.col("doc_id")
    mode = F.when(d % 4 == 0, None).when(d % 4 == 1, " OCR ").when(d % 4 == 2, "crops").otherwise("vl")
    provider = F.when(d % 9 == 0, "other").when(d % 9 < 5, "paddleocr")
    enabled = F.col("lang").isNotNull()
    gate = refine.refine_gate(enabled, F.col("n_chars") % 3, F.col("source").contains("a"), mode, F.col("n_chars") % 5 > 0)
    error = F.when(F.col("n_chars") % 7 == 0, "broken")
    return _docs(spark, sf_dir).select("doc_id", gate.alias("refine"), refine.refine_outcome(gate, enabled, provider, error, d % 9 % 2 == 0).alias("outcome"))


@query(f"""WITH {FIXTURES}, r AS (SELECT DISTINCT doc_id, page_index FROM blocks WHERE line_no >= 40), p AS (SELECT doc_id, page_index FROM r ANTI JOIN tables USING (doc_id, page_index))
SELECT doc_id, page_index, line_no, text, 'own' AS origin FROM blocks ANTI JOIN p USING (doc_id, page_index)
UNION ALL SELECT doc_id, page_index, line_no, '[' || text || ']', 'recognised' FROM blocks WHERE line_no >= 40 AND (doc_id, page_index) IN (SELECT (doc_id, page_index) FROM p)""")
def replaced_texts(spark, sf_dir):
    """Texts are recognised on all pages but the first here."""
    docs = _docs(spark, sf_dir)
    of = L.blocks(docs).select(*PAGE, "line_no", "text")
    again = of.where("page_index > 0").withColumn("text", F.concat(F.lit("["), "text", F.lit("]")))
    return refine.replace_texts(of, again, L.tables(docs)).select(*PAGE, "line_no", "text", "origin")


@query(f"""WITH {FIXTURES}, b AS (SELECT doc_id, page_index, 'r' || row_index AS html, count(*) AS n FROM cells GROUP BY 1, 2, row_index)
SELECT doc_id, page_index, count(*) AS table_count, count(html) AS html_count, CAST(sum(n) AS BIGINT) AS cell_count FROM b GROUP BY 1, 2""")
def page_table_counts(spark, sf_dir):
    cells = L.cells(_docs(spark, sf_dir))
    tables = cells.groupBy(*PAGE, "row_index").agg(F.collect_list("text").alias("cells")).withColumn("html", F.concat(F.lit("r"), F.col("row_index").cast("string")))
    return refine.page_counts(tables)


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, CAST(unnest(range(len(string_split(text, chr(10))))) AS INT) AS i FROM documents)
SELECT doc_id, 0 AS page_index, i AS ordinal, {ONE.format("line")} AS text, 10 * i + 1 AS x, 5 AS w FROM l WHERE {ONE.format("line")} <> ''""")
def polygon_lines(spark, sf_dir):
    """All lines of the documents as OCR arrays with polygons in place of boxes, and too few scores."""
    at = lambda i: F.array(F.array(10 * i + 1, F.lit(0)), F.array(10 * i + 6, F.lit(1)), F.array(10 * i + 6, F.lit(9)), F.array(10 * i + 1, F.lit(8)))
    lines = F.split("text", "\n")
    page = F.struct(F.struct(lines.alias("rec_texts"), F.transform(lines, lambda x, i: at(i)).alias("rec_polys"), F.array(F.lit(0.5)).alias("rec_scores")).alias("res"))
    rows = J.parsed(_docs(spark, sf_dir).where("text IS NOT NULL").select("doc_id", F.to_json(F.array(page)).alias("json")))
    return J.ocr_lines(rows).select("doc_id", "page_index", "ordinal", "text", "bounding_box.x", "bounding_box.w")


@query(_IN_LINES + """, halves AS (SELECT doc_id, page_index, line, x >= 300 AS half, string_agg(text, ' ' ORDER BY place) AS text FROM placed GROUP BY 1, 2, 3, 4)
SELECT doc_id, page_index, line, string_agg(text, ' | ' ORDER BY half) AS text FROM halves GROUP BY 1, 2, 3""")
def two_column_lines(spark, sf_dir):
    return refine.column_lines(reading.reading_order(L.blocks(_docs(spark, sf_dir))), F.lit(300.0))


@query(f"""WITH RECURSIVE {FIXTURES}, o AS (SELECT doc_id, page_index, row_index, trim(text, {BLANKS}) AS t, col_index, x FROM cells WHERE trim(text, {BLANKS}) <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_index, row_index ORDER BY col_index, x, t) AS n FROM o), {not_redundant("inrow", "r", "doc_id, page_index, row_index")},
l AS (SELECT doc_id, page_index, array_to_string(out, ' ') AS t, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY row_index) AS n FROM inrow WHERE len(out) > 0), {not_redundant("intable", "l", "doc_id, page_index")}
SELECT doc_id, page_index, array_to_string(out, chr(10)) AS text FROM intable""")
def table_text_without_repeats(spark, sf_dir):
    return refine.table_text_distinct(L.cells(_docs(spark, sf_dir)))


_IN_FIRST = "x + w / 2.0::DOUBLE <= 5000 AND y + 8.0::DOUBLE <= 100"


@query(f"""WITH {FIXTURES}, p AS (SELECT DISTINCT doc_id, page_index FROM blocks), t AS (SELECT doc_id, page_index, string_agg({ONE.format("text")}, chr(10) ORDER BY y, x, line_no) AS found FROM blocks WHERE {_IN_FIRST} GROUP BY 1, 2),
a AS (SELECT p.doc_id, p.page_index, 0 AS line_no, coalesce(found, 'region text') AS text, 0 AS x, 0 AS y, 5000 AS w, 100 AS h, 1 AS n_marks FROM p LEFT JOIN t USING (doc_id, page_index)
  UNION ALL SELECT doc_id, page_index, 2, 'region text', 0, 9000, 5000, 10, 0 FROM p UNION ALL SELECT doc_id, page_index, line_no + 1000000, text, x, y, w, h, 0 FROM blocks WHERE NOT ({_IN_FIRST}))
SELECT * FROM a WHERE regexp_matches(text, '[\\p{{L}}\\p{{N}}]')""".replace("\\\\", "\\"))
def pages_of_three_models(spark, sf_dir):
    """S20, C9; no two blocks of the fixture that overlap say the same, so the SQL need not look for such."""
    docs = _docs(spark, sf_dir)
    lines = L.blocks(docs).withColumn("confidence", F.lit(0.9))
    page = lines.select(*PAGE).distinct()
    place = lambda y, h: G.box(F.lit(0), F.lit(y), F.lit(5000), F.lit(h))
    region = lambda n, label, y, h: F.struct(F.lit(n).alias("line_no"), F.lit(label).alias("label"), F.lit("region text").alias("text"), place(y, h).alias("box"))
    layout = page.select(*PAGE, F.explode(F.array(region(0, "text", 0, 100), region(1, "table", 200, 50), region(2, "text", 9000, 10))).alias("r")).select(*PAGE, "r.*")
    marks = page.select(*PAGE, F.lit(0).alias("ordinal"), F.lit("seal").alias("text"), place(40, 30).alias("box"))
    return pages_from_models(layout, lines, marks).select(*PAGE, "line_no", "text", *SIDES, F.size("marks").alias("n_marks"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'd/a.md' WHEN 1 THEN 'd/a.JSON' WHEN 2 THEN 'd/paddle_table_structure.json' WHEN 3 THEN 'd/a.error.json' ELSE 'd/a.txt' END AS path,
  sha256(text || CASE WHEN doc_id % 5 < 2 THEN ' 签字盖章' ELSE ' 签字盖率' END) AS text_sha256 FROM documents WHERE text IS NOT NULL""")
def rewritten_artifacts(spark, sf_dir):
    """Whole texts as artifacts, the readable ones corrected."""
    d = F.col("doc_id") % 5
    path = F.when(d == 0, "d/a.md").when(d == 1, "d/a.JSON").when(d == 2, "d/paddle_table_structure.json").when(d == 3, "d/a.error.json").otherwise("d/a.txt")
    files = _docs(spark, sf_dir).where("text IS NOT NULL").select(path.alias("path"), F.concat("text", F.lit(" 签字盖率"), F.lit("#"), F.col("doc_id").cast("string")).alias("text"))
    done = refine.rewrite_texts(files.select("path", "text"))
    parts = F.split("text", "#", -1)
    return done.select(F.element_at(parts, -1).cast("bigint").alias("doc_id"), "path", F.sha2(F.regexp_replace("text", "#[0-9]+$", ""), 256).alias("text_sha256"))


@query(f"""WITH {FIXTURES}, p AS (SELECT DISTINCT doc_id, page_index FROM tables), k AS (SELECT b.*, t.doc_id IS NOT NULL AS has FROM blocks b LEFT JOIN p t USING (doc_id, page_index)),
o AS (SELECT * FROM k b WHERE NOT (has AND line_no % 3 = 0) AND NOT EXISTS (SELECT 1 FROM tables t WHERE t.doc_id = b.doc_id AND t.page_index = b.page_index AND b.x + b.w / 2.0::DOUBLE BETWEEN t.x AND t.x + t.w AND b.y + b.h / 2.0::DOUBLE BETWEEN t.y AND t.y + t.h))
SELECT doc_id, page_index, 0 AS kind, line_no, text FROM o UNION ALL SELECT doc_id, page_index, 2, row_index * 1000 + col_index, text FROM cells WHERE trim(text, {BLANKS}) <> ''""")
def fallback_blocks_dropped(spark, sf_dir):
    """On pages with tables, blocks of a fallback (every third line) go, wherever they lie."""
    from ..operators.tables import merge_refined

    docs = _docs(spark, sf_dir)
    of = L.blocks(docs).withColumn("source", F.when(F.col("line_no") % 3 == 0, "mineru_ocr_table_fallback").otherwise("own"))
    return merge_refined(of, L.tables(docs), L.cells(docs)).select(*PAGE, "kind", "line_no", "text")


@query(f"""WITH {FIXTURES}, {_REGIONS}, near AS ({_NEAR}), k AS (SELECT *, {KEY.format("text")} AS key FROM blocks)
SELECT b.doc_id, b.page_index, b.line_no, n.region, b.doc_id % 2 = 0 AND key <> '' AS confirmed, n.region IS NULL OR b.doc_id % 2 = 0 AND key <> '' AS render_text FROM k b LEFT JOIN near n USING (doc_id, page_index, line_no)""")
def annotated_seals(spark, sf_dir):
    """Blocks with the seal region that they belong to; on every second document a recognised text says the same, elsewhere only signs."""
    docs = _docs(spark, sf_dir)
    of = L.blocks(docs)
    texts = of.select(*PAGE, F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise("§§§§§§§§§§§§").alias("text"), "box")
    return refine.annotate_seals(of, _regions(docs), texts).select(*PAGE, "line_no", "region", "confirmed", "render_text")
