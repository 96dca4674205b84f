"""Queries on the readers of layout artifacts and on paths, over payloads that vary by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..sources import files
from ..sources import layout_json as J
from ..sources import layout_text as L
from ..sources.files import read_table
from .registry import BLANKS, Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _json(template: str, **values) -> Column:
    """A JSON text column: ``<name>`` in the template stands for a column, written as it casts to text."""
    values = {k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()}
    out, rest = [], template
    while any(f"<{k}>" in rest for k in values):
        at, name = min((rest.index(f"<{k}>"), k) for k in values if f"<{k}>" in rest)
        out += [F.lit(rest[:at]), values[name].cast("string")]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*out, F.lit(rest))


def _lines(spark, sf_dir) -> DataFrame:
    """(doc_id, i, line, n): a row for each line of the documents, and its length."""
    docs = L.read_documents(spark, sf_dir)
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")).select("doc_id", "i", "line", F.char_length("line").alias("n"))


_LINES = "l AS (SELECT doc_id, CAST(unnest(range(len(string_split(text, chr(10))))) AS INT) AS i, unnest(string_split(text, chr(10))) AS line, unnest(list_transform(string_split(text, chr(10)), lambda x: length(x))) AS n FROM documents)"


def _payloads(spark, sf_dir, entry: Column, around: tuple[str, str]) -> DataFrame:
    """(doc_id, json): the entries of a document's lines, in order, as one JSON text."""
    of = _lines(spark, sf_dir).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", entry.alias("e")))), lambda x: x["e"]), ",").alias("entries"))
    return J.parsed(of.select("doc_id", F.concat(F.lit(around[0]), "entries", F.lit(around[1])).alias("json")))


@query(f"""WITH {_LINES} SELECT doc_id, i AS ordinal, CASE WHEN i % 4 = 0 THEN i ELSE i % 3 END AS page_index, CAST(n AS INT) AS x, CASE WHEN i % 5 = 0 THEN '/abs/' || i || '.png' ELSE 'base/' || i || '.png' END AS image_uri,
  CASE WHEN i % 2 = 0 THEN '<table>' || n || '</table>' ELSE 'h' || i END AS html, 'c' || i || chr(10) || 'd' AS caption, CASE WHEN i % 3 > 0 THEN 'foot' END AS footnote FROM l WHERE i % 6 <> 1""")
def flat_table_list(spark, sf_dir):
    """The tables of flat block lists: captions as lists or texts, html under two names, pages missing, images absolute or not."""
    i, n = F.col("i"), F.col("n")
    entry = _json(
        '{"type":"<kind>",<page>"bbox":[<n>,0,9999999,9],"img_path":"<img>","table_body":"<body>","html":"h<i>","table_caption":["c<i>"," ","d "],"table_footnote":<foot>}',
        kind=F.when(i % 6 == 1, "text").otherwise("table"), page=F.when(i % 4 == 0, "").otherwise(F.concat(F.lit('"page_idx":'), (i % 3).cast("string"), F.lit(","))), n=n,
        img=F.when(i % 5 == 0, F.concat(F.lit("/abs/"), i.cast("string"), F.lit(".png"))).otherwise(F.concat(i.cast("string"), F.lit(".png"))),
        body=F.when(i % 2 == 0, F.concat(F.lit("<table>"), n.cast("string"), F.lit("</table>"))).otherwise(" "), i=i, foot=F.when(i % 3 > 0, F.lit('" foot "')).otherwise(F.lit('[" "]')),
    )
    found = J.flat_tables(_payloads(spark, sf_dir, entry, ("[", "]")), base="base")
    return found.select("doc_id", "ordinal", "page_index", "bounding_box.x", "image_uri", "html", "caption", "footnote")


@query(f"""WITH {_LINES} SELECT doc_id, i AS page_index, k AS cell_index, 'p' || i || '-t0-c' || k AS cell_id, CAST(round_even(k * 10 * CASE WHEN i % 2 = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END + n, 0) AS INT) AS x,
  CAST(round_even(CASE WHEN i % 2 = 0 THEN 4.0::DOUBLE ELSE 8.0::DOUBLE END, 0) AS INT) AS w, CASE WHEN i % 4 < 2 THEN 0.5::DOUBLE END AS confidence, CASE WHEN i % 3 = 0 THEN '<html>' || i ELSE '<td></td>' END AS html FROM l, (VALUES (0), (2)) v(k)""")
def structure_result_cells(spark, sf_dir):
    """Cells of table-structure results, in an envelope, moved and scaled into the page; one of three boxes is none."""
    i, n = F.col("i"), F.col("n")
    text = _json(
        '{"<env>":{"<boxes>":[[0,0,8,4],[1,2],[20,0,28,4]],"structure_score":<score>,<html>"structure":["<td>","</td>"]}}', env=F.when(i % 2 == 0, "res").otherwise("output"),
        boxes=F.when(i % 3 == 0, "bbox").otherwise("cell_box_list"), score=F.when(i % 4 < 2, "0.5").otherwise("1.5"), html=F.when(i % 3 == 0, F.concat(F.lit('"pred_html":" <html>'), i.cast("string"), F.lit('",'))).otherwise(F.lit("")),
    )
    box = F.struct(n.cast("int").alias("x"), F.lit(0).alias("y"), F.lit(50).alias("w"), F.lit(20).alias("h"))
    size = F.when(i % 2 == 0, 100)
    rows = J.parsed(_lines(spark, sf_dir).select("doc_id", i.alias("page_index"), F.lit(0).alias("table_index"), box.alias("box"), size.alias("image_width"), size.alias("image_height"), text.alias("json")))
    return J.structure_cells(rows).select("doc_id", "page_index", "cell_index", "cell_id", "box.x", "box.w", "confidence", "html")


@query(f"""WITH {_LINES}, p AS (SELECT *, CASE WHEN i % 2 = 0 THEN i ELSE 7 END AS page_index, CASE WHEN i % 3 = 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS f FROM l)
SELECT doc_id, page_index, 'parsing_res_list' AS origin, 0 AS ordinal, 'a & b ' || i AS text, CAST(10 * f AS INT) AS x, 'paddle_seal' AS block_type, 0.25::DOUBLE AS confidence FROM p
UNION ALL SELECT doc_id, page_index, 'parsing_res_list', 2, 'x' || chr(10) || 'y z', CAST(5 * f AS INT), 'paddle_text', 0.75::DOUBLE FROM p
UNION ALL SELECT doc_id, page_index, 'overall_ocr_res', 0, CAST(n % 10000 AS VARCHAR), CAST(2 * f AS INT), CASE WHEN f = 1 THEN 'page_number' ELSE 'page_number' END, 0.5::DOUBLE FROM p
UNION ALL SELECT doc_id, page_index, 'overall_ocr_res', 1, 'word ' || i, CAST(4 * f AS INT), 'paddle_ocr_text', NULL FROM p
UNION ALL SELECT doc_id, i, 'raw_results', i, 'crop ' || n, CASE WHEN i % 2 = 0 THEN 3 ELSE 6 END, 'paddle_table', 0.1::DOUBLE FROM l""")
def recognised_text_candidates(spark, sf_dir):
    """Texts of layout artifacts: blocks (tables blanked, other tags stripped), whole-page recognition with page numbers, crops."""
    i, n = F.col("i"), F.col("n")
    page = _json(
        '{"res":{<page>"width":<w>,"height":<h>,"parsing_res_list":[{"block_label":" seal ","block_bbox":[10,0,30,9],"block_content":" a &amp; b <i> <","score":0.25},'
        '{"block_label":"table","bbox":[0,0,1,1],"block_content":"<table><tr>"},{"bbox":[30,0,5,9],"block_content":"","html":"<p>x<br/>y</td>z</p>","confidence":0.75},{"bbox":[1,2],"text":"no box"}],'
        '"overall_ocr_res":{"rec_texts":["<n>"," word <i>","",null],"rec_boxes":[[2,0,9,2],[4,0,9,9],[0,0,1,1]],"rec_scores":[0.5]}}}',
        page=F.when(i % 2 == 0, F.concat(F.lit('"page_index":'), i.cast("string"), F.lit(","))).otherwise(F.lit('"page_index":7,')), w=F.when(i % 3 == 0, 50).otherwise(0), h=F.when(i % 3 == 0, 50).otherwise(100), n=n % 10000, i=i,
    )
    pages = F.regexp_replace(page, "&amp; b (\\d+) <", "&amp; <b>b</b> $1")
    crop = _json('{"candidate":{"page_index":<i>,"bbox":<box>},"result":{"structure_score":0.1,"<env>":"crop <n>"}}', i=i, n=n, box=F.when(i % 2 == 0, '{"x":3,"y":0,"w":9,"h":9}').otherwise("[6,0,9,9]"), env=F.lit("text"))
    both = _lines(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("i", pages.alias("p"), crop.alias("c")))).alias("es"))
    joined = lambda f: F.array_join(F.transform("es", lambda e: e[f]), ",")
    rows = J.parsed(both.select("doc_id", F.concat(F.lit('{"pages":['), joined("p"), F.lit('],"raw_results":['), joined("c"), F.lit("]}")).alias("json")))
    return J.text_candidates(rows, target_width=F.lit(100.0), target_height=F.lit(100.0)).select("doc_id", "page_index", "origin", "ordinal", "text", "bounding_box.x", "block_type", "confidence")


@query(f"""WITH {_LINES} SELECT doc_id, i AS page_index, k AS ordinal, CASE k WHEN 0 THEN 'seal' ELSE 'stamp' END AS label, CASE k WHEN 0 THEN 'seal of ' || n ELSE '' END AS text, CASE k WHEN 0 THEN 1 ELSE 5 END AS x FROM l, (VALUES (0), (2)) v(k)""")
def layout_label_regions(spark, sf_dir):
    """Regions of two labels, in any case, in page order."""
    entry = _json('{"parsing_res_list":[{"block_label":" Seal","block_bbox":[1,0,9,9],"block_content":"seal of <n>"},{"block_label":"text","block_bbox":[1,0,9,9]},{"block_label":"STAMP","bbox":[9,0,5,9]},{"block_label":"seal"}]}', n=F.col("n"))
    found = J.layout_regions(_payloads(spark, sf_dir, entry, ("[", "]")), labels=("seal", "stamp"))
    return found.select("doc_id", "page_index", "ordinal", "label", "text", "bounding_box.x")


@query(f"""WITH {_LINES} SELECT doc_id, i % 3 AS page_index, count(*) AS n_blocks, string_agg(trim(line, {BLANKS}), chr(10) ORDER BY i) AS texts FROM l WHERE trim(line, {BLANKS}) <> '' GROUP BY 1, 2""")
def blocks_by_page(spark, sf_dir):
    """Flat blocks of all lines, grouped by page, in the order of the list."""
    i = F.col("i")
    entry = F.to_json(F.struct(F.lit("text").alias("type"), F.col("line").alias("text"), F.array(*map(F.lit, (0, 0, 9, 9))).alias("bbox"), (i % 3).alias("page_idx")))
    found = J.by_page(J.flat_blocks(_payloads(spark, sf_dir, entry, ("[", "]"))), "doc_id")
    return found.select("doc_id", "page_index", F.size("blocks").cast("bigint").alias("n_blocks"), F.array_join(F.transform("blocks", lambda b: b["text"]), "\n").alias("texts"))


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '/data/a b/' || c_custkey || '+1.pdf' WHEN 1 THEN '/plain/' || c_custkey || '.pdf' WHEN 3 THEN '/z' || c_custkey WHEN 4 THEN 'rel/é.png' END AS path,
  CASE WHEN c_custkey % 3 = 0 THEN 'NOT_FOUND' WHEN c_custkey % 7 = 0 THEN 'NOT_A_FILE' WHEN c_custkey % 5 IN (2, 3) THEN 'UNSUPPORTED' END AS problem,
  CASE WHEN c_custkey % 4 = 0 THEN 'none' ELSE c_name END AS name, 'e|' || CASE WHEN c_custkey % 4 = 0 THEN 'none' ELSE CAST(c_custkey AS VARCHAR) END AS trial, right(c_name || c_name, 20) AS tail FROM customer""")
def local_paths(spark, sf_dir):
    """S3, S26, Q4, X8, T21 on addresses of several schemes."""
    c = F.col("c_custkey")
    k = c.cast("string")
    uri = (
        F.when(c % 5 == 0, F.concat(F.lit("file:///data/a%20b/"), k, F.lit("+1.pdf"))).when(c % 5 == 1, F.concat(F.lit("/plain/"), k, F.lit(".pdf")))
        .when(c % 5 == 2, F.lit("s3://bucket/x")).when(c % 5 == 3, F.concat(F.lit("FILE://host/z"), k)).otherwise(F.lit("rel/é.png"))
    )
    named = read_table(spark, f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", uri.alias("uri"))
    return named.select(
        "c_custkey", files.local_path(F.col("uri")).alias("path"), files.path_problem(F.col("uri"), c % 3 != 0, c % 7 != 0).alias("problem"),
        V.text_or(F.when(c % 4 == 0, "  ").otherwise(F.col("c_name")), "none").alias("name"), V.trial_key(F.lit("e"), F.when(c % 4 != 0, c)).alias("trial"),
        T.log_tail(F.concat("c_name", "c_name"), 20).alias("tail"),
    )


@query("""WITH f AS (SELECT s_suppkey, 'd/' || s_suppkey || CASE s_suppkey % 9 WHEN 0 THEN '_middle.json' WHEN 1 THEN '_content_list.json' WHEN 2 THEN '_content_list_v2.json' WHEN 3 THEN '_model.json' WHEN 4 THEN '.md'
  WHEN 5 THEN '_layout.pdf' WHEN 6 THEN '_span.pdf' WHEN 7 THEN '_origin.pdf' ELSE '.log' END AS uri, s_suppkey % 9 AS k FROM supplier)
SELECT s_suppkey, uri, CASE k WHEN 0 THEN 'middle_json' WHEN 1 THEN 'content_list_json' WHEN 2 THEN 'content_list_v2_json' WHEN 3 THEN 'model_json' WHEN 4 THEN 'markdown' WHEN 5 THEN 'layout_pdf' WHEN 6 THEN 'span_pdf' ELSE 'origin_pdf' END AS kind,
  CASE WHEN k = 4 THEN uri END AS markdown FROM f WHERE k < 8""")
def artifact_refs(spark, sf_dir):
    """Artifacts by the ends of their names, one of each, and the address of the one of a kind."""
    k = F.col("s_suppkey") % 9
    ends = ["_middle.json", "_content_list.json", "_content_list_v2.json", "_model.json", ".md", "_layout.pdf", "_span.pdf", "_origin.pdf", ".log"]
    end = F.element_at(F.array(*map(F.lit, ends)), (k + 1).cast("int"))
    listed = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", F.concat(F.lit("d/"), F.col("s_suppkey").cast("string"), end).alias("path"))
    found = listed.select("s_suppkey", files.artifact_kind(F.col("path")).alias("kind"), F.col("path").alias("uri")).where("kind is not null")
    one = files.exactly_one(found, "s_suppkey", "kind", wanted=found)
    ref = F.array(F.struct("kind", "uri"))
    return one.select("s_suppkey", "uri", "kind", V.artifact_uri(ref, "markdown").alias("markdown"))


@query("""WITH f AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN upper('in/' || (c_custkey // 3) || '.pdf') ELSE 'in/' || (c_custkey // 3) || '.pdf' END AS path FROM customer), o AS (SELECT min(path) AS path FROM f GROUP BY lower(path))
SELECT path FROM o ORDER BY lower(path), path LIMIT 50""")
def first_paths(spark, sf_dir):
    """One file of each path in any case, the first in order of path."""
    c = F.col("c_custkey")
    path = F.concat(F.lit("in/"), F.floor(c / 3).cast("string"), F.lit(".pdf"))
    return files.first_paths(read_table(spark, f"{sf_dir}/customer.parquet").select(F.when(c % 3 == 0, F.upper(path)).otherwise(path).alias("path")), 50)
