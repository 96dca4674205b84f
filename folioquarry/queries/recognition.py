"""Queries on recognition by pluggable readers, and on whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import recognise as R
from ..operators.reading import page_text_plain
from ..operators.search import keyword_table
from ..operators.spatial import PAGE
from ..plans import document_results_plan
from ..sources import layout_text as L
from .registry import BLANKS, FIXTURES, Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql

#: What makes a text one that the readers of these queries refuse.
_BAD = "\u0001unreadable"


def _refined(spark, sf_dir, options: R.Options) -> R.Refined:
    """All documents, a third each without a mode, by crops and by pages; every seventh cannot be read. The first reader loses a cell of each crop, the second does not."""
    docs = L.read_documents(spark, sf_dir)
    d = F.col("doc_id")
    blocks = L.blocks(docs)
    bad = F.when(d % 7 == 0, F.lit(_BAD)).otherwise(F.lit(""))
    piped = blocks.where(F.col("text").contains(" | "))
    texts = page_text_plain(piped).select(*PAGE, F.concat("text", bad).cast("binary").alias("content"))
    html = L.cells(docs).groupBy(*PAGE).agg(F.repeat(F.lit("<td>x</td>"), F.count("*").cast("int")).alias("html"))
    candidates = L.tables(docs).join(texts, [*PAGE]).join(html, [*PAGE]).select(*PAGE, F.lit(0).alias("candidate_no"), "box", "html", "content")
    pages = page_text_plain(blocks).select(*PAGE, F.concat("text", bad).cast("binary").alias("content"))
    mode = F.when(d % 3 == 1, "mineru_crops").when(d % 3 == 2, "ppstructurev3")
    reader = lambda name, loses=0: R.TextReader(loses, _BAD, name)
    return R.refine(docs.select("doc_id", mode.alias("mode")), blocks, candidates, pages, options, reader("crops", 1), reader("pages"), second=reader("second"))


_MODES = f"""{FIXTURES}, c AS (SELECT doc_id, count(*) AS n FROM tables GROUP BY 1), b AS (SELECT doc_id, count(*) AS n FROM blocks GROUP BY 1),
g AS (SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 1 OR d.doc_id % 3 <> 2 AND coalesce(c.n, 0) > 0 OR coalesce(c.n, 0) > 0 AND d.doc_id % 3 = 2 THEN 'table_structure' ELSE 'ppstructurev3' END AS mode,
  d.doc_id % 3 = 0 OR coalesce(c.n, 0) > 0 AS gate, coalesce(c.n, 0) AS crops, coalesce(b.n, 0) AS lines FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN b USING (doc_id)),
o AS (SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN 'ppstructurev3' ELSE mode END AS mode, gate, crops, lines FROM g),
f AS (SELECT *, gate AND doc_id % 7 = 0 AND CASE WHEN mode = 'table_structure' THEN crops > 0 ELSE lines > 0 END AS failed FROM o)"""


@query(f"""WITH {_MODES} SELECT doc_id, mode, CASE WHEN NOT gate THEN 'skipped' WHEN failed THEN 'warned' ELSE 'merged' END AS outcome, CASE WHEN failed THEN 'READ_FAILED' END AS code FROM f""")
def refined_documents(spark, sf_dir):
    """What became of each document, errors leaving its pages as they are."""
    outcomes = _refined(spark, sf_dir, R.Options()).outcomes
    return outcomes.select("doc_id", "mode", "outcome", F.col("error.code").alias("code"))


@query(f"""WITH {_MODES}, k AS (SELECT *, dense_rank() OVER (PARTITION BY doc_id, page_index ORDER BY row_index) - 1 AS r FROM cells)
SELECT k.doc_id, page_index, CAST(r AS INT) AS row_index, col_index, k.text, CASE WHEN mode = 'table_structure' THEN 'crops' ELSE 'pages' END AS provider, mode = 'table_structure' AS fallback FROM k JOIN f USING (doc_id) WHERE gate AND NOT failed""")
def recognised_cells(spark, sf_dir):
    """The cells of all documents that were merged; crops of which the first reader lost a cell are the second reader's."""
    tables = _refined(spark, sf_dir, R.Options()).tables
    return tables.select(*PAGE, "provider", "fallback", F.explode("cells").alias("c")).select(*PAGE, "c.row_index", "c.col_index", "c.text", "provider", "fallback")


@query(f"""WITH {_MODES}, k AS (SELECT doc_id, count(*) AS cells, count(DISTINCT page_index) AS tables FROM cells GROUP BY 1)
SELECT doc_id, tables AS table_count, cells AS cell_count, tables AS n_raw, CASE WHEN failed THEN 'failed' ELSE 'merged' END AS closed FROM k JOIN f USING (doc_id) WHERE gate AND NOT failed""")
def recognition_artifacts(spark, sf_dir):
    """One artifact per document, with tables by page and the readers' own words, of a run that fails closed."""
    refined = _refined(spark, sf_dir, R.Options(fail_open=False))
    v = F.parse_json("json")
    part = lambda path, kind: F.try_variant_get(v, path, kind)
    made = R.artifact(refined).select("doc_id", part("$.table_count", "bigint").alias("table_count"), part("$.cell_count", "bigint").alias("cell_count"), F.size(part("$.raw_results", "array<string>")).cast("bigint").alias("n_raw"))
    return made.join(refined.outcomes.select("doc_id", F.col("outcome").alias("closed")), "doc_id")


_PROBES = ("the", "tion", "und")
_IN_TABLE = "b.x + b.w / 2.0::DOUBLE BETWEEN t.x AND t.x + t.w AND b.y + b.h / 2.0::DOUBLE BETWEEN t.y AND t.y + t.h"


@query()
def whole_documents(spark, sf_dir):
    """C11: all steps of a single-document run, for all documents at once."""
    docs = L.read_documents(spark, sf_dir).select("doc_id", "text")
    found = document_results_plan(docs, keyword_table(spark, list(_PROBES)), cells=L.cells(docs), tables_=L.tables(docs))
    pages = F.from_json("result", "pages array<struct<page_index: int>>")["pages"]
    return found.select("doc_id", "error_code", "page_count", "block_count", "cell_count", "match_count", F.char_length("markdown").alias("markdown_chars"), F.size(pages).alias("pages_in_result"))


@query(f"""WITH {FIXTURES}, p AS (SELECT doc_id, page_index, CAST(max(x + w) AS INT) AS width FROM blocks GROUP BY 1, 2), f AS (SELECT doc_id, arg_min(width, page_index) AS width, count(*) AS page_count FROM p GROUP BY 1)
SELECT d.doc_id, 't' AS trace_id, 'r' AS run_id, coalesce(page_count, 0) AS page_count, CASE WHEN page_count IS NULL OR d.doc_id % 2 = 0 THEN 'mineru_layout' ELSE 'pixels' END AS coord_space,
  CASE WHEN page_count IS NOT NULL THEN 'model ' || coalesce(d.lang, 'none') END AS layout_provider, f.width, CASE WHEN d.doc_id % 3 = 0 THEN '' ELSE 'markdown:out/' || d.doc_id || '.md' END AS artifacts FROM documents d LEFT JOIN f USING (doc_id)""")
def run_results(spark, sf_dir):
    """Results of single-document runs, with what the first page tells."""
    from ..operators.base import Context
    from ..operators.documents import run_results as results

    docs = L.read_documents(spark, sf_dir)
    space = F.when(F.col("doc_id") % 2 == 1, "pixels")
    pages = L.blocks(docs).groupBy(*PAGE).agg(F.max(F.col("box.x") + F.col("box.w")).alias("width"), F.count("*").alias("n_blocks"))
    pages = pages.join(docs.select("doc_id", F.concat(F.lit("model "), F.coalesce("lang", F.lit("none"))).alias("layout_provider")), "doc_id").withColumn("coord_space", space)
    name = F.concat(F.lit("out/"), F.col("doc_id").cast("string"), F.lit(".md"))
    artifacts = docs.where("doc_id % 3 > 0").select("doc_id", F.lit("markdown").alias("kind"), name.alias("uri"))
    found = results(pages, docs.select("doc_id", F.lit("x.pdf").alias("file_uri")), artifacts.unionByName(artifacts), Context(trace_id="t", run_id="r"))
    shown = F.array_join(F.transform("artifacts", lambda a: F.concat(a["kind"], F.lit(":"), a["uri"])), ",")
    return found.select("doc_id", "trace_id", "run_id", "page_count", "coord_space", "layout_provider", "width", shown.alias("artifacts"))


@query(f"""WITH {FIXTURES}, p AS (SELECT DISTINCT doc_id, page_index FROM blocks), o AS (SELECT * FROM blocks b WHERE NOT EXISTS (SELECT 1 FROM tables t WHERE t.doc_id = b.doc_id AND t.page_index = b.page_index AND {_IN_TABLE})),
m AS (SELECT doc_id, page_index, 0 AS kind, line_no, text FROM o UNION ALL SELECT doc_id, page_index, 2, row_index * 1000 + col_index, text FROM cells),
s AS (SELECT doc_id, page_index, string_agg(trim(text, {BLANKS}), chr(10) ORDER BY kind, line_no, text) AS text FROM m WHERE trim(text, {BLANKS}) <> '' GROUP BY 1, 2), t AS (SELECT doc_id, page_index, 1 AS n FROM tables)
SELECT doc_id, page_index, sha256(coalesce(text, '')) AS text_sha256, CAST(coalesce(n, 0) AS INT) AS n_tables FROM (SELECT DISTINCT doc_id, page_index FROM m) LEFT JOIN s USING (doc_id, page_index) LEFT JOIN t USING (doc_id, page_index)""")
def merged_page_texts(spark, sf_dir):
    """The texts of pages anew after their tables were merged, beside the tables."""
    from ..operators import tables

    docs = L.read_documents(spark, sf_dir)
    merged = tables.merge_refined(L.blocks(docs), L.tables(docs), L.cells(docs))
    own = L.tables(docs).withColumn("table_no", F.lit(0))
    pages = tables.with_tables(tables.merged_texts(merged), own)
    return pages.select(*PAGE, F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), F.size("tables").alias("n_tables"))
