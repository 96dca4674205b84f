"""Queries on repairs of tables and Markdown, and on documents, options and results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import documents as D
from ..operators import reading, repair
from ..operators.base import Context
from ..operators.spatial import PAGE
from ..sources import layout_text as L
from ..sources.files import read_table
from .layout import _INSIDE, _REGIONS, _regions
from .registry import BLANKS, FIXTURES, Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql
SIDES = ["box.x", "box.y", "box.w", "box.h"]


def _docs(spark, sf_dir) -> DataFrame:
    return L.read_documents(spark, sf_dir)


_DAY = "(2020 + doc_id % 6)"


@query(f"""WITH c AS (SELECT doc_id, unnest([0, 0, 0, 1, 1, 1, 2, 2, 2]) AS row_index, unnest([0, 1, 2, 0, 1, 2, 0, 1, 2]) AS col_index,
  unnest(['name', '实名认证时间', 'result', 'n' || doc_id, '', '', 'n' || doc_id, '2日', '2021年1月2日']) AS t FROM documents)
SELECT doc_id, row_index, col_index, CASE WHEN col_index = 1 AND row_index > 0 AND doc_id % 3 > 0 THEN {_DAY} || '年' || (doc_id % 12 + 1) || '月' || (doc_id % 28 + 1) || '日' ELSE t END AS text, col_index = 1 AND row_index > 0 AND doc_id % 3 > 0 AS repaired FROM c""")
def repaired_days(spark, sf_dir):
    """Cut and missing days in columns of days, from the serial number of the page's text; two of three pages have one."""
    d = F.col("doc_id")
    said = [(0, 0, F.lit("name")), (0, 1, F.lit("实名认证时间")), (0, 2, F.lit("result")), (1, 0, None), (1, 1, F.lit("")), (1, 2, F.lit("")), (2, 0, None), (2, 1, F.lit("2日")), (2, 2, F.lit("2021年1月2日"))]
    own = F.concat(F.lit("n"), d.cast("string"))
    cells = F.array(*[F.struct(F.lit(r).alias("row_index"), F.lit(c).alias("col_index"), (own if t is None else t).alias("text")) for r, c, t in said])
    docs = _docs(spark, sf_dir).select("doc_id", F.lit(0).alias("page_index"), cells.alias("cells"))
    serial = F.concat(F.lit("流水号:510604Y3"), (d % 6 + 2020).cast("string"), F.lpad((d % 12 + 1).cast("string"), 2, "0"), F.lpad((d % 28 + 1).cast("string"), 2, "0"), F.lit("0001 end"))
    pages = docs.select(*PAGE, F.when(d % 3 > 0, serial).otherwise("no number 12345678").alias("text"))
    return repair.repaired_days(docs.select(*PAGE, F.explode("cells").alias("c")).select(*PAGE, "c.*"), pages, *PAGE).select("doc_id", "row_index", "col_index", "text", "repaired")


_NUMBERED = "lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0')"


@query(f"""SELECT doc_id, sha256('510604Y3' || {_DAY} || {_NUMBERED} || '0001' || chr(10) || '| name | a\\|b | 日期 |' || chr(10) || '| --- | --- | --- |' || chr(10) || '| a | c\\|d | ' || {_DAY} || '年' || (doc_id % 12 + 1) || '月' || (doc_id % 28 + 1) || '日 |'
  || chr(10) || '| b | e | 2021年1月2日 |' || chr(10) || chr(10) || text || chr(10) || 'x | y |  |') AS markdown_sha256 FROM documents WHERE text IS NOT NULL""".replace("\\\\", "\\"))
def repaired_pipes(spark, sf_dir):
    """Days in pipe tables with escaped pipes, from a serial number; whole texts around them, and rows of pipes that are no table, stay."""
    d = F.col("doc_id")
    serial = F.concat(F.lit("510604Y3"), (d % 6 + 2020).cast("string"), F.lpad((d % 12 + 1).cast("string"), 2, "0"), F.lpad((d % 28 + 1).cast("string"), 2, "0"), F.lit("0001"))
    table = "\n| name | a\\|b | 日期 |\n| --- | --- | --- |\n| a | c\\|d | 2日 |\n| b | e | 2021年1月2日 |\n\n"
    text = F.concat(serial, F.lit(table), F.col("text"), F.lit("\nx | y |  |"))
    return _docs(spark, sf_dir).where("text IS NOT NULL").select("doc_id", F.sha2(repair.repaired_pipes(text), 256).alias("markdown_sha256"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, '| ' || l_linenumber || ' | ' || l_returnflag || ' |  | a\\|' || l_linestatus || ' |' AS line FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY 1, 2))
SELECT l_orderkey, '| n | 角色 | 签字信息 | s |' || chr(10) || '| --- | --- | --- | --- |' || chr(10) || string_agg(line, chr(10) ORDER BY l_linenumber) AS markdown FROM r GROUP BY 1""".replace("\\\\", "\\"))
def pipe_tables_of_cells(spark, sf_dir):
    """Pipe tables of orders' cells whose column numbers collide, the column of signatures blanked."""
    items = read_table(spark, f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("l_returnflag"), F.min("l_linestatus").alias("l_linestatus"))
    cell = lambda c, x, t: F.struct(F.lit(c).alias("col_index"), t.cast("string").alias("text"), G.box(F.lit(x), F.lit(0), F.lit(9), F.lit(9)).alias("box"))
    body = items.select("l_orderkey", F.col("l_linenumber").cast("int").alias("row_index"), F.explode(F.array(
        cell(0, 0, F.col("l_linenumber")), cell(2, 90, F.concat(F.lit("a|"), F.col("l_linestatus"))), cell(1, 50, F.lit("7")), cell(1, 20, F.col("l_returnflag")),
    )).alias("c"))
    head = items.select("l_orderkey").distinct().select("l_orderkey", F.lit(0).alias("row_index"), F.explode(F.array(cell(0, 0, F.lit("n")), cell(1, 20, F.lit("角色")), cell(1, 50, F.lit("签字信息")), cell(2, 90, F.lit("s")))).alias("c"))
    return repair.pipe_rows(head.unionByName(body).select("l_orderkey", "row_index", "c.*"), "l_orderkey")


@query(f"""WITH {FIXTURES}, {_REGIONS}, c AS (SELECT doc_id, page_index, ordinal AS cell_no, x, y, w, h FROM regions),
hit AS (SELECT b.doc_id, b.page_index, b.line_no, b.text, b.x, b.y, min(t.cell_no) AS cell_no FROM blocks b JOIN c t ON t.doc_id = b.doc_id AND t.page_index = b.page_index AND {_INSIDE} GROUP BY 1, 2, 3, 4, 5, 6),
s AS (SELECT doc_id, page_index, cell_no, string_agg(trim(text), '' ORDER BY y, x, trim(text)) AS text, count(*) AS n FROM hit GROUP BY 1, 2, 3)
SELECT c.doc_id, c.page_index, c.cell_no, coalesce(text, '') AS text, coalesce(n, 0) AS n_fragments FROM c LEFT JOIN s USING (doc_id, page_index, cell_no)""".replace("trim(text)", "trim(text, ' ' || chr(9) || chr(13))"))
def fragments_into_cells(spark, sf_dir):
    """The texts of a page's blocks, run together in the regions that they are centred in."""
    docs = _docs(spark, sf_dir)
    fragments = L.blocks(docs).withColumnRenamed("line_no", "ordinal")
    return repair.fragments_into_cells(_regions(docs).withColumnRenamed("ordinal", "cell_no"), fragments, *PAGE).select(*PAGE, "cell_no", "text", "n_fragments")


@query(f"""WITH {FIXTURES}, n AS (SELECT doc_id, page_index, count(*) AS c FROM blocks GROUP BY 1, 2) SELECT doc_id, page_index, line_no, x, y, w, h, doc_id % 2 = 0 AND c > 1 AS flipped FROM blocks JOIN n USING (doc_id, page_index)""")
def upright_fragments(spark, sf_dir):
    """Every second document's pages turned upside down, and back."""
    of = L.blocks(_docs(spark, sf_dir)).withColumnRenamed("line_no", "ordinal")
    area = of.groupBy(*PAGE).agg((F.min("box.x") + F.max(F.col("box.x") + F.col("box.w"))).alias("sx"), (F.min("box.y") + F.max(F.col("box.y") + F.col("box.h"))).alias("sy"))
    turned = G.box(F.col("sx") - F.col("box.x") - F.col("box.w"), F.col("sy") - F.col("box.y") - F.col("box.h"), F.col("box.w"), F.col("box.h"))
    given = of.join(area, [*PAGE]).select(*PAGE, "ordinal", "text", F.when(F.col("doc_id") % 2 == 0, turned).otherwise(F.col("box")).alias("box"))
    return repair.upright(given, *PAGE).select(*PAGE, F.col("ordinal").alias("line_no"), *SIDES, "flipped")


@query(f"""WITH {FIXTURES}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY row_index, col_index) - 1 AS cell_no FROM cells),
g AS (SELECT doc_id, page_index, cell_no, CASE cell_no % 4 WHEN 0 THEN ' ' WHEN 1 THEN 'X' ELSE text END AS text, x, y, w, h FROM k),
hit AS (SELECT t.doc_id, t.page_index, t.cell_no, string_agg(trim(b.text, ' ' || chr(9) || chr(13)), '' ORDER BY b.y, b.x, b.line_no) AS seen FROM g t JOIN blocks b ON b.doc_id = t.doc_id AND b.page_index = t.page_index AND {_INSIDE} WHERE t.cell_no % 4 < 2 OR regexp_full_match(trim(t.text), '[A-Za-z?*_-]?') GROUP BY 1, 2, 3)
SELECT doc_id, page_index, cell_no, coalesce(seen, text) AS text, seen IS NOT NULL AS page_text_fallback FROM g LEFT JOIN hit USING (doc_id, page_index, cell_no)""")
def cells_filled_from_page(spark, sf_dir):
    """Blank cells, and ones that hold one letter, with the page's lines centred in them."""
    from pyspark.sql import Window

    docs = _docs(spark, sf_dir)
    number = F.row_number().over(Window.partitionBy(*PAGE).orderBy("row_index", "col_index")) - 1
    cells = L.cells(docs).select(*PAGE, number.alias("cell_no"), "text", "box")
    given = cells.withColumn("text", F.when(F.col("cell_no") % 4 == 0, " ").when(F.col("cell_no") % 4 == 1, "X").otherwise(F.col("text")))
    return repair.filled_from_page(given, L.blocks(docs)).select(*PAGE, F.col("cell_no").cast("bigint").alias("cell_no"), "text", "page_text_fallback")


@query(f"""WITH {FIXTURES}, n AS (SELECT doc_id, page_index, count(*) AS c, count(*) FILTER (col_index % 2 = 0 OR doc_id % 2 = 0) AS had FROM cells GROUP BY 1, 2)
SELECT doc_id, page_index, row_index, col_index, had < c AS fallback FROM cells JOIN n USING (doc_id, page_index) WHERE had < c OR col_index % 2 = 0 OR doc_id % 2 = 0""")
def covering_cells(spark, sf_dir):
    """Cells of a first recogniser, or of a second one where the first has fewer than the html."""
    cells = L.cells(_docs(spark, sf_dir)).select(*PAGE, "row_index", "col_index")
    html = cells.groupBy(*PAGE).agg(F.concat(F.lit("<tr>"), F.repeat(F.lit("<td>x</td>"), F.count("*").cast("int")), F.lit("</tr>")).alias("html"))
    return repair.covering(cells.where("col_index % 2 = 0 OR doc_id % 2 = 0"), cells, html, *PAGE).select(*PAGE, "row_index", "col_index", "fallback")


@query(f"""WITH d AS (SELECT doc_id, 'body ' || doc_id || chr(10) || '印章：' || chr(10) || '日期' || chr(10) || chr(10) || text || chr(10) || chr(10) || 'footer' AS t FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, trim(regexp_replace(t, '\n{{3,}}', chr(10) || chr(10), 'g'), {BLANKS}) AS t FROM d)
SELECT doc_id, sha256(t || CASE doc_id % 4 WHEN 0 THEN chr(10) || chr(10) || '印章：' || chr(10) || chr(10) || 'code ' || doc_id WHEN 3 THEN '' ELSE chr(10) || chr(10) || '印章：' || chr(10) || chr(10) || 'seal ' || doc_id END || chr(10)) AS markdown_sha256, true AS stable,
  '| a | b |' || chr(10) || chr(10) || 'http://f' || doc_id AS footer FROM k""".replace("\\n", "\n"))
def seal_sections(spark, sf_dir):
    """One section of seals after whole texts, however often it is made, the title elsewhere being text; and footers apart from pipe rows."""
    d = F.col("doc_id")
    n = d.cast("string")
    seal, code = F.concat(F.lit("seal "), n), F.concat(F.lit("code "), n)
    old = F.when(d % 2 == 0, "\n印章：\n\nold\nolder\n").otherwise("")
    text = F.concat(F.lit("body "), n, F.lit("\n印章：\n日期\n\n![](images/seal.jpg)  \n"), F.when(d % 4 < 3, F.concat(seal, F.lit("\n"))).otherwise(""), F.col("text"), F.lit("\n\nfooter\n"), old)
    none = F.array().cast("array<string>")
    given = F.when(d % 4 < 3, F.array(seal)).otherwise(none), F.array(F.lit("images/seal.jpg")), F.when(d % 4 == 0, F.array(code, F.lit(" "))).otherwise(none)
    once = _docs(spark, sf_dir).where("text IS NOT NULL").select("doc_id", repair.with_seals(text, *given).alias("markdown"))
    again = once.select("doc_id", F.sha2("markdown", 256).alias("markdown_sha256"), (repair.with_seals(F.col("markdown"), *given) == F.col("markdown")).alias("stable"))
    return again.select("doc_id", "markdown_sha256", "stable", repair.separate_footers(F.concat(F.lit("| a | b |http://f"), n)).alias("footer"))


@query(f"""WITH {FIXTURES}, p AS (SELECT doc_id, page_index, string_agg(text, chr(10) ORDER BY line_no) AS text FROM blocks GROUP BY 1, 2)
SELECT doc_id, 'in/' || doc_id || '.pdf' AS source_pdf, doc_id || '.pdf' AS source_file_name, CAST(count(*) AS INT) AS page_count, string_agg(page_index || ':' || length(text), ',' ORDER BY page_index) AS pages FROM p GROUP BY 1""")
def document_results(spark, sf_dir):
    """Results of whole documents in their outer shape."""
    docs = _docs(spark, sf_dir)
    path = F.concat(F.lit("in/"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    found = D.document_results(reading.page_text_plain(L.blocks(docs)), docs.select("doc_id", path.alias("file_uri")))
    shown = F.array_join(F.transform("pages", lambda p: F.concat_ws(":", p["page_index"], F.char_length(p["text"]))), ",")
    return found.select("doc_id", "source_pdf", "source_file_name", "page_count", shown.alias("pages"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'en' ELSE 'ch' END AS lang, 'true' AS refine, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS DOUBLE) * 10 END AS timeout_seconds,
  CASE WHEN c_custkey % 5 > 0 THEN CAST(c_custkey % 5 AS INT) END AS requested_concurrency, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 5 > 2 END AS exceeds, 'v9' AS config_version,
  CASE WHEN c_custkey % 7 = 0 THEN 'out/' || c_custkey || '/operate_error.json' WHEN c_custkey % 7 = 1 THEN 'rec/' || 'd_' || c_custkey || '-t-1-operate_error.json' ELSE 'logs/operator_failures/d_' || c_custkey || '-t-1-operate_error.json' END AS record FROM customer""")
def run_options(spark, sf_dir):
    """Options by precedence, what they say of limits, and where a failure would be recorded."""
    c = F.col("c_custkey")
    k = c.cast("string")
    pairs = F.array_compact(F.array(
        F.when(c % 3 == 0, F.struct(F.lit("lang").alias("k"), F.lit("en").alias("v"))), F.struct(F.lit("timeout_seconds").alias("k"), F.concat((c % 4).cast("string"), F.lit("0")).alias("v")),
        F.struct(F.lit("caller_concurrency").alias("k"), F.lit("no number").alias("v")), F.struct(F.lit("concurrency").alias("k"), (c % 5).cast("string").alias("v")),
        F.when(c % 7 == 0, F.struct(F.lit("output_dir").alias("k"), F.concat(F.lit("out/"), k).alias("v"))), F.when(c % 7 == 1, F.struct(F.lit("failure_record_dir").alias("k"), F.lit("rec").alias("v"))),
    ))
    context = Context(trace_id="t:1".replace(":", "-"), config_version="v9")
    of = read_table(spark, f"{sf_dir}/customer.parquet").select("c_custkey", D.options_of(F.map_from_entries(pairs), "paddle", context).alias("o"))
    o, s = F.col("o"), D.safety(F.col("o"), recommended=2)
    return of.select(
        "c_custkey", o["lang"].alias("lang"), o["enable_table_cell_refine"].alias("refine"), s["timeout_seconds"].alias("timeout_seconds"), s["requested_concurrency"].alias("requested_concurrency"),
        s["exceeds_recommendation"].alias("exceeds"), o["config_version"].alias("config_version"), D.record_path(o, F.concat(F.lit("d/"), k), context).alias("record"),
    )


@query("""SELECT 'mineru' AS archive_id, 'p_' || c_custkey AS doc_id, 'in/p ' || c_custkey || '.jpg' AS file_uri, 'image/jpeg' AS mime_type FROM customer""")
def documents_of_paths(spark, sf_dir):
    """Documents from bare paths."""
    paths = read_table(spark, f"{sf_dir}/customer.parquet").select(F.concat(F.lit("in/p "), F.col("c_custkey").cast("string"), F.lit(".jpg")).alias("path"))
    return D.documents_of(paths).select("archive_id", "doc_id", "file_uri", "mime_type")


@query(f"""WITH {FIXTURES}, e AS (SELECT doc_id, page_index, max(x + w) AS rx, max(y + h) AS ry FROM blocks GROUP BY 1, 2), s AS (SELECT *, rx > 900 * 1.05::DOUBLE OR ry > 500 * 1.05::DOUBLE AS wrong FROM e)
SELECT doc_id, page_index, CASE WHEN NOT wrong THEN 900.0::DOUBLE END AS width, CASE WHEN NOT wrong THEN 500.0::DOUBLE END AS height FROM s""")
def believed_page_sizes(spark, sf_dir):
    """Sizes of pages that their content does not belie."""
    of = L.blocks(_docs(spark, sf_dir))
    extents = of.groupBy(*PAGE).agg(F.max(F.col("box.x") + F.col("box.w")).alias("width"), F.max(F.col("box.y") + F.col("box.h")).alias("height"))
    pages = of.select(*PAGE).distinct().select(*PAGE, F.lit(900.0).alias("width"), F.lit(500.0).alias("height"))
    return D.page_sizes(pages, extents)


@query(f"""WITH {FIXTURES}, c AS (SELECT doc_id, line_no, greatest(0, x - 50) AS x0, greatest(0, y - 50) AS y0, least(400, x - 50 + w) AS x1, least(300, y - 50 + h) AS y1 FROM blocks)
SELECT doc_id, line_no, CASE WHEN x1 > x0 AND y1 > y0 THEN x0 END AS x, CASE WHEN x1 > x0 AND y1 > y0 THEN y0 END AS y, CASE WHEN x1 > x0 AND y1 > y0 THEN x1 - x0 END AS w, CASE WHEN x1 > x0 AND y1 > y0 THEN y1 - y0 END AS h FROM c""")
def crop_boxes(spark, sf_dir):
    """Boxes clipped to a picture."""
    moved = G.box(F.col("box.x") - 50, F.col("box.y") - 50, F.col("box.w"), F.col("box.h"))
    of = L.blocks(_docs(spark, sf_dir)).select("doc_id", "line_no", D.crop_box(moved, F.lit(400), F.lit(300)).alias("box"))
    return of.select("doc_id", "line_no", *SIDES)


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'a' || c_custkey || '|b' WHEN 1 THEN 'x|y z' WHEN 2 THEN 'q|r' WHEN 3 THEN '[bad' ELSE '' END AS keywords, '{"a":"/new/' || c_custkey || '","b":["/new","/older/x","/n2/y"],"c":' || c_custkey || '}' AS moved,
  c_custkey % 2 = 0 AS has_image, c_custkey % 3 = 0 AS whole_page, 'k' AS kept FROM customer""")
def json_helpers(spark, sf_dir):
    """Keywords from JSON or text, moved paths in open JSON, and facts of candidates."""
    c = F.col("c_custkey")
    k = c.cast("string")
    text = F.when(c % 5 == 0, F.concat(F.lit('["a'), k, F.lit('"," ","b"]'))).when(c % 5 == 1, '"x, y z"').when(c % 5 == 2, "q，r").when(c % 5 == 3, "[bad").otherwise(F.lit(None))
    value = F.parse_json(F.concat(F.lit('{"a": "/old/auto/'), k, F.lit('", "b": ["/old/auto", "/older/x", "/old/y"], "c": '), k, F.lit("}")))
    of = read_table(spark, f"{sf_dir}/customer.parquet").select("c_custkey", F.when(c % 2 == 0, "i.png").otherwise(" ").alias("image_uri"))
    images = D.with_image(of).select("c_custkey", F.lit(True).alias("has_image"))
    meta = D.without_html(F.create_map(F.lit("html"), F.lit("h"), F.lit("kept"), F.lit("k")))
    return of.join(images, "c_custkey", "left").select(
        "c_custkey", F.array_join(D.keyword_list(text), "|").alias("keywords"), F.to_json(D.relocated(value, [("/old/auto", "/new"), ("/old", "/n2")])).alias("moved"), F.coalesce("has_image", F.lit(False)).alias("has_image"),
        D.whole_page(F.when(c % 3 == 0, "overall_ocr_res")).alias("whole_page"), F.array_join(F.map_values(meta), ",").alias("kept"),
    )


@query(f"""WITH {FIXTURES}, o AS (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id, page_index ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM blocks),
m AS (SELECT *, greatest(0, 5 - off) AS a, least(length(text), 60 - off) AS b FROM o WHERE off < 60 AND off + length(text) > 5)
SELECT doc_id, page_index, line_no, CAST(x + floor(a * (w / length(text)::DOUBLE)) AS INT) AS x, y, CAST(ceil((b - a) * (w / length(text)::DOUBLE)) AS INT) AS w, h FROM m""")
def phrase_boxes(spark, sf_dir):
    """The boxes that the characters 5 to 60 of every page's text lie in."""
    of = L.blocks(_docs(spark, sf_dir))
    phrases = of.select(*PAGE).distinct().select(*PAGE, F.lit(5).alias("char_start"), F.lit(60).alias("char_end"))
    return D.phrase_boxes(of.select(*PAGE, "line_no", "text", "box"), phrases).select(*PAGE, "line_no", *SIDES)


@query("""SELECT event_type, CAST(n AS INT) AS n, CAST(row_number() OVER (ORDER BY event_type, n) AS INT) AS place FROM (SELECT DISTINCT event_type, event_id % 10 AS n FROM events)""")
def trials_in_order(spark, sf_dir):
    """Trials by their key, and results in the order of their inputs."""
    from ..operators.report import chunks

    trials = read_table(spark, f"{sf_dir}/events.parquet").select("event_type", (F.col("event_id") % 10).cast("int").alias("n")).distinct()
    numbered = chunks(trials, ["event_type", "n"], 1).withColumn("key", F.concat_ws("|", "event_type", "n"))
    shuffled = D.trials_in_order(trials, "event_type", "n").select("event_type", "n", F.concat_ws("|", "event_type", "n").alias("key"))
    return D.in_input_order(shuffled, numbered, "key", "chunk").select("event_type", "n", (F.col("chunk") + 1).alias("place"))


@query("""WITH d AS (SELECT doc_id, unnest(CASE WHEN doc_id % 3 = 0 THEN ['a/' || doc_id || '.md', 'b/' || doc_id || '.md'] ELSE ['out/' || doc_id || '/s.md'] END) AS path FROM documents WHERE doc_id % 5 > 0)
SELECT doc_id, path, 'text ' || doc_id AS text, doc_id % 3 > 0 AS added, CASE WHEN doc_id % 2 = 0 THEN 'a' || chr(10) || 'b' WHEN doc_id % 4 = 1 THEN 'f' END AS page_text FROM d""")
def markdown_targets(spark, sf_dir):
    """Where Markdown goes, and page texts by preference."""
    d = F.col("doc_id")
    n = d.cast("string")
    docs = _docs(spark, sf_dir).select("doc_id")
    texts = docs.select("doc_id", F.when(d % 5 > 0, F.concat(F.lit("text "), n)).otherwise(" ").alias("markdown"))
    ref = lambda kind, uri: F.struct(F.lit(kind).alias("kind"), uri.alias("uri"))
    refs = F.array(ref("markdown", F.concat(F.lit("a/"), n, F.lit(".md"))), ref("markdown", F.concat(F.lit("b/"), n, F.lit(".md"))), ref("model_json", n), ref("markdown", F.lit(" ")))
    artifacts = docs.where(d % 3 == 0).select("doc_id", F.explode(refs).alias("r")).select("doc_id", "r.*")
    folders = docs.select("doc_id", F.concat(F.lit("out/"), n, F.lit("/")).alias("artifact_dir"), F.lit("s").alias("output_stem"))
    page = D.text_of_page(F.when(d % 2 == 0, F.array(F.lit("a"), F.lit(" "), F.lit("b"))).otherwise(F.array(F.lit(" "))), F.when(d % 4 == 1, F.array(F.lit("f"))))
    return D.markdown_targets(texts, artifacts, folders).select("doc_id", "path", "text", "added", page.alias("page_text"))
