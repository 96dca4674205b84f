"""Queries on open JSON, Markdown and pictures, over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import jsontree
from ..functions import markdown as M
from ..operators import documents as D
from ..operators import refine, repair
from ..sources import layout_text as L
from ..sources import pictures
from ..sources.files import read_table
from .layout import _IN_LINES
from .registry import BLANKS, ONE, Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _docs(spark, sf_dir):
    return L.read_documents(spark, sf_dir).where("text IS NOT NULL")


@query("""SELECT doc_id, '/new/d' || doc_id || '/a.md' AS path, '/new' AS folder, '/older/x' AS near, 'see "/old/x" here' AS said, true AS has_key, '/old/k' AS key, sha256(text) AS text_sha256, CAST(len(string_split(text, chr(10))) AS INT) AS n_lines FROM documents WHERE text IS NOT NULL""")
def relocated_paths(spark, sf_dir):
    """Paths in trees that hold whole texts, with quotes, escapes and line ends; keys and sentences that mention a path stay."""
    d = F.col("doc_id").cast("string")
    tree = F.to_json(F.struct(
        F.struct(F.concat(F.lit("/old/auto/d"), d, F.lit("/a.md")).alias("path"), F.lit("/old/auto/").alias("folder")).alias("here"), F.array(F.lit("/older/x"), F.lit('see "/old/x" here')).alias("list"),
        F.create_map(F.lit("/old/k"), F.lit(1)).alias("map"), F.col("text").alias("text"), F.split("text", "\n").alias("lines"),
    ))
    got = _docs(spark, sf_dir).select("doc_id", D.relocated(F.parse_json(tree), [("/old/auto", "/new"), ("/old", "/new")]).alias("v"))
    part = lambda path, kind="string": F.try_variant_get("v", path, kind)
    keys = F.map_keys(part("$.map", "map<string,int>"))
    return got.select(
        "doc_id", part("$.here.path").alias("path"), F.rtrim(part("$.here.folder"), F.lit("/")).alias("folder"), part("$.list[0]").alias("near"), part("$.list[1]").alias("said"),
        F.array_contains(keys, "/old/k").alias("has_key"), keys[0].alias("key"), F.sha2(part("$.text"), 256).alias("text_sha256"), F.size(part("$.lines", "array<string>")).alias("n_lines"),
    )


@query("""SELECT doc_id, sha256(text || ' 签字盖章 "x" \\ ') AS text_sha256, '签字盖率' AS key, CAST(length(text) AS INT) AS number FROM documents WHERE text IS NOT NULL""".replace("\\\\", "\\"))
def corrected_trees(spark, sf_dir):
    """Misreadings set right in whole texts within JSON; the key that is one, and numbers, stay."""
    text = F.concat(F.col("text"), F.lit(' 签字盖率 "x" \\ '))
    tree = F.to_json(F.struct(F.array(F.struct(text.alias("签字盖率"), F.char_length("text").alias("n"))).alias("a")))
    got = _docs(spark, sf_dir).select("doc_id", refine.correct_json(F.parse_json(tree)).alias("v"))
    inner = F.try_variant_get("v", "$.a[0]", "map<string,variant>")
    key = F.filter(F.map_keys(inner), lambda k: k != "n")[0]
    return got.select("doc_id", F.sha2(F.try_variant_get("v", "$.a[0]['签字盖率']", "string"), 256).alias("text_sha256"), key.alias("key"), F.try_variant_get("v", "$.a[0].n", "int").alias("number"))


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL)
SELECT doc_id, '# d' || doc_id || chr(10) || chr(10) || '| n | line |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || i || ' | ' || replace({ONE.format("line")}, '|', '\\|') || ' |', chr(10) ORDER BY i) || chr(10) || chr(10) || 'end' AS markdown, true AS stable FROM l GROUP BY 1""".replace("\\\\", "\\"))
def html_in_markdown(spark, sf_dir):
    """An HTML table of all lines of a text, within Markdown, as a pipe table; once more changes nothing."""
    code = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&#62;"))
    rows = F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.lit("<tr><td>"), i.cast("string"), F.lit("</td>\n<TD class='a'>"), code(x), F.lit("</TD></tr>")))
    text = F.concat(F.lit("# d"), F.col("doc_id").cast("string"), F.lit("\n<table border=1><tr><th>n</th><th>line</th></tr>"), F.array_join(rows, ""), F.lit("</table>\nend"))
    once = M.pipes_for_html(_docs(spark, sf_dir).select("doc_id", text.alias("markdown")))
    again = M.pipes_for_html(once.withColumn("once", F.col("markdown")))
    return again.select("doc_id", "markdown", (F.col("markdown") == F.col("once")).alias("stable"))


@query("""SELECT doc_id, sha256(text) AS text_sha256, true AS whole, CAST(1 AS BIGINT) AS pipes, CAST(doc_id % 2 AS BIGINT) AS seals FROM documents WHERE text IS NOT NULL""")
def markdown_segments(spark, sf_dir):
    """The segments of Markdown around a whole text put together are the Markdown; the text itself stays prose."""
    table, seal = "| a | b\\|c |\n| --- | --- |\n| 1 | 2 |\n", "\n\n印章：\n\ncompany\n"
    text = F.concat(F.lit(table + "\n"), "text", F.lit("\n<table><tr><td>x</td></tr></table>"), F.when(F.col("doc_id") % 2 == 1, seal).otherwise(""))
    cut = _docs(spark, sf_dir).select("doc_id", text.alias("markdown"), M.segments(text).alias("s"))
    count = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("bigint")
    prose = F.regexp_replace(F.regexp_replace(F.array_join(F.transform(F.filter("s", lambda x: x["kind"] == "prose"), lambda x: x["text"]), ""), r"\A\n", ""), r"\n(\n\n)?\z", "")
    return cut.select("doc_id", F.sha2(prose, 256).alias("text_sha256"), (M.joined(F.col("s")) == F.col("markdown")).alias("whole"), count("pipe").alias("pipes"), count("seal").alias("seals"))


_HALVES = ", m AS (SELECT doc_id, page_index, (min(x) + max(x + w)) / 2.0::DOUBLE AS middle FROM blocks GROUP BY 1, 2), halves AS (SELECT doc_id, page_index, line, x >= middle AS half, string_agg(text, ' ' ORDER BY place) AS text FROM placed JOIN m USING (doc_id, page_index) GROUP BY 1, 2, 3, 4)"


@query(_IN_LINES + _HALVES + f""", l AS (SELECT doc_id, page_index, line, trim(string_agg(text, ' | ' ORDER BY half), {BLANKS}) AS text FROM halves GROUP BY 1, 2, 3),
r AS (SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY page_index, line, text) AS text FROM l GROUP BY 1),
c AS (SELECT doc_id, '| ' || string_agg(text, ' | ' ORDER BY col_index, x, text) || ' |' AS line, page_index, row_index, count(*) AS n FROM (SELECT doc_id, page_index, row_index, col_index, x, replace({ONE.format("text")}, '|', '\\|') AS text FROM cells) GROUP BY doc_id, page_index, row_index),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY row_index) AS nth FROM c),
t AS (SELECT doc_id, page_index, string_agg(line || CASE WHEN nth = 1 THEN chr(10) || repeat('| --- ', n) || '|' ELSE '' END, chr(10) ORDER BY row_index) AS markdown FROM k GROUP BY 1, 2),
ts AS (SELECT doc_id, string_agg(markdown, chr(10) || chr(10) ORDER BY page_index) AS markdown FROM t GROUP BY 1)
SELECT d.doc_id, CASE doc_id % 3 WHEN 0 THEN coalesce(r.text || chr(10), 'lost') WHEN 1 THEN coalesce(r.text || chr(10) || chr(10) || '印章：' || chr(10) || chr(10) || 'seal ' || doc_id || chr(10), 'lost') ELSE 'lost' || coalesce(chr(10) || chr(10) || ts.markdown, '') END AS markdown
FROM documents d LEFT JOIN r USING (doc_id) LEFT JOIN ts USING (doc_id)""".replace("\\\\", "\\"))
def rebuilt_markdown(spark, sf_dir):
    """documents' Markdown made anew from blocks, from blocks and seals, and from cells, by mode."""
    docs = L.read_documents(spark, sf_dir)
    mode = F.when(F.col("doc_id") % 3 == 0, "ppocrv5").when(F.col("doc_id") % 3 == 1, "seal_vl_crops_ppocrv5").otherwise("ppstructurev3")
    given = docs.select("doc_id", F.lit("lost").alias("markdown"), mode.alias("mode"))
    body = L.blocks(docs).select("doc_id", "page_index", F.lit("text").alias("block_type"), "text", "box")
    first = body.select("doc_id").distinct()
    seals = first.where("doc_id % 3 = 1").select("doc_id", F.lit(0).alias("page_index"), F.lit("seal_text").alias("block_type"), F.concat(F.lit(" seal "), F.col("doc_id").cast("string")).alias("text"), G.box(F.lit(1), F.lit(1), F.lit(5), F.lit(5)).alias("box"))
    cells = L.cells(docs).withColumn("table_no", F.lit(0))
    return repair.rebuilt_markdown(given, body.unionByName(seals), cells)


@query("""WITH d AS (SELECT doc_id, coalesce(length(text), 0) % 60000 + 1 AS w, len(string_split(coalesce(text, ''), chr(10))) AS h FROM documents)
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'png' WHEN 1 THEN 'gif' WHEN 2 THEN 'bmp' WHEN 3 THEN 'jpeg' WHEN 4 THEN 'tiff' END AS kind, CASE WHEN doc_id % 6 < 5 THEN CAST(w AS INT) END AS width, CASE WHEN doc_id % 6 < 5 THEN CAST(h AS INT) END AS height FROM d""")
def picture_sizes(spark, sf_dir):
    """Headers of five kinds, each as wide as its document has characters and as high as it has lines; a sixth kind is none."""
    docs = L.read_documents(spark, sf_dir)
    text = F.coalesce("text", F.lit(""))
    w, h = F.char_length(text) % 60000 + 1, F.size(F.split(text, "\n"))
    big = lambda n, v: F.format_string(f"%0{2 * n}X", v)
    little = lambda n, v: F.concat(*[F.substring(big(n, v), 2 * i + 1, 2) for i in reversed(range(n))])
    entry = lambda tag, v: F.concat(F.lit(tag), F.lit("0400"), F.lit("01000000"), little(4, v))
    k = F.col("doc_id") % 6
    digits = (
        F.when(k == 0, F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), big(4, w), big(4, h)))
        .when(k == 1, F.concat(F.lit("474946383961"), little(2, w), little(2, h)))
        .when(k == 2, F.concat(F.lit("424D" + "00" * 16), little(4, w), little(4, h)))
        .when(k == 3, F.concat(F.lit("FFD8FFE000040000FFFFC0001108"), big(2, h), big(2, w), F.lit("00")))
        .when(k == 4, F.concat(F.lit("49492A00080000000200"), entry("0001", w), entry("0101", h)))
        .otherwise(F.lit("00FF"))
    )
    return pictures.facts(docs.select("doc_id", F.unhex(digits).alias("content")))


@query("""SELECT l_orderkey, l_linenumber, CAST(l_partkey % 1000 AS INT) AS x, CAST(l_suppkey % 500 AS INT) AS y, CASE WHEN l_linenumber % 5 < 4 THEN CAST(l_linenumber * 10 AS INT) END AS w, CASE WHEN l_linenumber % 5 < 4 THEN 8 END AS h FROM lineitem WHERE l_linenumber % 5 < 4
UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL, NULL, NULL FROM lineitem WHERE l_linenumber % 5 = 4""")
def open_boxes(spark, sf_dir):
    """Boxes given as an object, as corners, as a polygon and as points; and one that is none."""
    items = read_table(spark, f"{sf_dir}/lineitem.parquet")
    x, y, n = F.col("l_partkey") % 1000, F.col("l_suppkey") % 500, F.col("l_linenumber")
    x1, y1 = x + n * 10, y + 8
    text = (
        F.when(n % 5 == 0, F.format_string('{"x":%d,"y":"%d","w":%d,"h":8.0}', x, y, n * 10)).when(n % 5 == 1, F.format_string("[%d,%d,%d,%d]", x1, y1, x, y))
        .when(n % 5 == 2, F.format_string("[%d,%d,%d,%d,%d,%d,%d,%d]", x, y, x1, y, x1, y1, x, y1)).when(n % 5 == 3, F.format_string('[[%d,%d],[1],["a",2],[%d,%d,9]]', x, y1, x1, y)).otherwise(F.lit('{"a":1}'))
    )
    return items.select("l_orderkey", "l_linenumber", G.from_open(F.parse_json(text)).alias("b")).select("l_orderkey", "l_linenumber", "b.x", "b.y", "b.w", "b.h")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 5 = 1 THEN NULL ELSE value END AS value, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, strftime(ts, '%Y-%m-%d') AS day, CAST(event_id AS VARCHAR) AS key FROM events""")
def json_safe_rows(spark, sf_dir):
    """Events with numbers that are not finite, times, days and numbers as keys, as JSON holds them."""
    e = F.col("event_id")
    value = F.when(e % 5 == 0, float("nan")).when(e % 5 == 1, float("-inf")).otherwise(F.col("value"))
    rows = read_table(spark, f"{sf_dir}/events.parquet").select("event_id", F.struct(F.array(value).alias("v"), F.col("ts").alias("t"), F.to_date("ts").alias("d"), F.create_map(e, F.lit(1)).alias("m")).alias("s"))
    safe = jsontree.safe_rows(rows)
    return safe.select("event_id", F.col("s.v")[0].alias("value"), F.col("s.t").alias("ts"), F.col("s.d").alias("day"), F.map_keys("s.m")[0].alias("key"))
