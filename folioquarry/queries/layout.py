"""Queries on layout rows: search, spatial joins, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from ..operators import reading, search, spatial, tables
from ..operators.spatial import PAGE
from ..plans import field_search_plan, merge_artifact_text
from ..sources import layout_text as L
from .registry import BLANKS, FIXTURES, KEY, ONE, Registry, not_redundant

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql

KEYWORDS = ["the", "tion", "est un", "und"]
SIDES = ["box.x", "box.y", "box.w", "box.h"]
_WORDS = ", ".join(f"('{k}')" for k in KEYWORDS)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.read_documents(spark, sf_dir)


@query(f"""WITH {FIXTURES},
words AS (SELECT k AS keyword, {KEY.format("k")} AS word_key FROM (VALUES {_WORDS}) v(k)),
rows AS (SELECT doc_id, page_index, text, x, y, w, h, 'mineru_text_block' AS source, 'mineru_text' AS source_class, 2 AS rank FROM blocks
  UNION ALL SELECT doc_id, page_index, text, x, y, w, h, 'table_cell', 'table_cell', 0 FROM cells),
keyed AS (SELECT *, {KEY.format("text")} AS text_key FROM rows),
hits AS (SELECT k.*, keyword FROM keyed k JOIN words ON contains(text_key, word_key) WHERE text_key <> ''),
one AS (SELECT doc_id, keyword, page_index, text_key, x, y, w, h, min(rank) AS rank, arg_min(source, rank) AS source, arg_min(source_class, rank) AS source_class, min(text) AS text
  FROM hits GROUP BY 1, 2, 3, 4, 5, 6, 7, 8),
best AS (SELECT *, min(rank) OVER (PARTITION BY doc_id, keyword, page_index, text_key) AS least FROM one)
SELECT doc_id, keyword, page_index, text, x, y, w, h, source, source_class, page_index + 1 AS page_number FROM best WHERE rank = least""")
def field_keyword_search(spark, sf_dir):
    found = field_search_plan(spark, _docs(spark, sf_dir), KEYWORDS)
    return found.select("doc_id", "keyword", "page_index", "text", *SIDES, "source", "source_class", "page_number")


@query(f"WITH {FIXTURES} SELECT doc_id, page_index, line_no, text, x, y, w, h FROM blocks")
def text_blocks_from_documents(spark, sf_dir):
    return L.blocks(_docs(spark, sf_dir)).select(*PAGE, "line_no", "text", *SIDES)


@query(f"WITH {FIXTURES} SELECT doc_id, page_index, row_index, col_index, text, x, y, w, h FROM cells")
def table_cells_from_documents(spark, sf_dir):
    return L.cells(_docs(spark, sf_dir)).select(*PAGE, "row_index", "col_index", "text", *SIDES)


@query(f"""WITH {FIXTURES}, p AS (SELECT doc_id, page_index, count(*) AS n, max(x + w) AS width FROM blocks GROUP BY 1, 2)
SELECT doc_id, count(*) AS parsed_pages, array_to_string(list_sort(list(page_index)), ',') AS page_numbers, CAST(sum(n) AS BIGINT) AS n_blocks, arg_min(width, page_index) AS first_width FROM p GROUP BY doc_id""")
def page_rollup(spark, sf_dir):
    from ..operators.report import document_rollup

    of = L.blocks(_docs(spark, sf_dir)).groupBy(*PAGE).agg(F.count("*").alias("n_blocks"), F.max(F.col("box.x") + F.col("box.w")).alias("width"))
    return document_rollup(of).withColumn("page_numbers", F.array_join(F.col("page_numbers").cast("array<string>"), ","))


@query(f"""WITH {FIXTURES}, p AS (SELECT a.doc_id, a.page_index, a.line_no AS left_no, b.line_no AS right_no,
  greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) AS i,
  greatest(1, a.w * a.h) AS aa, greatest(1, b.w * b.h) AS ab FROM blocks a JOIN blocks b USING (doc_id, page_index) WHERE a.line_no < b.line_no)
SELECT doc_id, page_index, left_no, right_no, round(i / least(aa, ab)::DOUBLE, 6) AS score FROM p WHERE i / least(aa, ab)::DOUBLE >= 0.05""")
def bbox_overlap_pairs(spark, sf_dir):
    of = L.blocks(_docs(spark, sf_dir))
    later = lambda a, b: (G.overlap(a, b) >= 0.05) & (F.col("l.line_no") < F.col("r.line_no"))
    score = F.round(G.overlap(F.col("l.box"), F.col("r.box")), 6)
    return spatial.pairs(of, of, later).select("l.doc_id", "l.page_index", F.col("l.line_no").alias("left_no"), F.col("r.line_no").alias("right_no"), score.alias("score"))


@query(f"""WITH {FIXTURES}, p AS (SELECT a.doc_id, a.page_index, a.line_no AS left_no, b.line_no AS right_no,
  greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) AS i, a.w * a.h + b.w * b.h AS s
  FROM blocks a JOIN blocks b USING (doc_id, page_index) WHERE a.line_no < b.line_no)
SELECT doc_id, page_index, left_no, right_no, round(i / (s - i)::DOUBLE, 6) AS score FROM p WHERE i > 0 AND i / (s - i)::DOUBLE >= 0.02""")
def bbox_iou_pairs(spark, sf_dir):
    of = L.blocks(_docs(spark, sf_dir))
    later = lambda a, b: (G.iou(a, b) >= 0.02) & (F.col("l.line_no") < F.col("r.line_no"))
    score = F.round(G.iou(F.col("l.box"), F.col("r.box")), 6)
    return spatial.pairs(of, of, later).select("l.doc_id", "l.page_index", F.col("l.line_no").alias("left_no"), F.col("r.line_no").alias("right_no"), score.alias("score"))


_INSIDE = "b.x + b.w / 2.0::DOUBLE BETWEEN t.x AND t.x + t.w AND b.y + b.h / 2.0::DOUBLE BETWEEN t.y AND t.y + t.h"


@query(f"""WITH {FIXTURES} SELECT doc_id, page_index, count(*) AS n FROM blocks b WHERE NOT EXISTS (
  SELECT 1 FROM tables t WHERE t.doc_id = b.doc_id AND t.page_index = b.page_index AND {_INSIDE}) GROUP BY 1, 2""")
def blocks_outside_tables(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return spatial.outside(L.blocks(docs), L.tables(docs)).groupBy(*PAGE).agg(F.count("*").alias("n"))


@query(f"""WITH {FIXTURES} SELECT doc_id, page_index, line_no FROM blocks b WHERE NOT EXISTS (
  SELECT 1 FROM tables t WHERE t.doc_id = b.doc_id AND t.page_index = b.page_index AND
  greatest(0, least(b.x + b.w, t.x + t.w) - greatest(b.x, t.x)) * greatest(0, least(b.y + b.h, t.y + t.h) - greatest(b.y, t.y))
  >= 0.15::DOUBLE * least(greatest(1, b.w * b.h), greatest(1, t.w * t.h)))""")
def blocks_not_overlapping_tables(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return spatial.outside(L.blocks(docs), L.tables(docs), spatial.at_least(G.overlap, 0.15)).select(*PAGE, "line_no")


def _regions(docs: DataFrame) -> DataFrame:
    """Two regions a page, over every text's first lines, as a layout model would give them."""
    page = L.blocks(docs).select(*PAGE).distinct()
    place = lambda y, h: G.box(F.lit(0), F.lit(y), F.lit(400), F.lit(h))
    both = F.array(F.struct(F.lit(0).alias("ordinal"), place(30, 90).alias("box")), F.struct(F.lit(1).alias("ordinal"), place(100, 200).alias("box")))
    return page.select(*PAGE, F.explode(both).alias("r")).select(*PAGE, "r.ordinal", "r.box")


_REGIONS = """regions AS (SELECT DISTINCT doc_id, page_index, ordinal, 0 AS x, y, 400 AS w, h FROM blocks, (VALUES (0, 30, 90), (1, 100, 200)) v(ordinal, y, h)
  ) """.replace("SELECT DISTINCT doc_id, page_index, ordinal, 0 AS x, y, 400 AS w, h FROM blocks", "SELECT DISTINCT blocks.doc_id, blocks.page_index, v.ordinal, 0 AS x, v.y, 400 AS w, v.h FROM blocks")


@query(f"""WITH {FIXTURES}, {_REGIONS}, c AS (SELECT doc_id, page_index, ordinal AS cell_no, x, y, w, h FROM regions),
hit AS (SELECT b.doc_id, b.page_index, b.line_no, b.text, b.x, b.y, min(t.cell_no) AS cell_no FROM blocks b JOIN c t ON t.doc_id = b.doc_id AND t.page_index = b.page_index AND {_INSIDE} GROUP BY 1, 2, 3, 4, 5, 6)
SELECT doc_id, page_index, cell_no, string_agg(text, chr(10) ORDER BY y, x, line_no) AS text, count(*) AS n_blocks, round(avg((line_no % 10) / 10.0::DOUBLE), 6) AS confidence FROM hit GROUP BY 1, 2, 3""")
def cell_text_fill(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    of = L.blocks(docs).withColumn("confidence", (F.col("line_no") % 10) / F.lit(10.0))
    filled = spatial.fill_cells(_regions(docs).withColumnRenamed("ordinal", "cell_no"), of)
    return filled.withColumn("confidence", F.round("confidence", 6))


_NEAR = """SELECT b.doc_id, b.page_index, b.line_no, min(r.ordinal) AS region FROM blocks b JOIN regions r ON r.doc_id = b.doc_id AND r.page_index = b.page_index WHERE
  greatest(0, least(b.x + b.w, r.x + r.w) - greatest(b.x, r.x)) * greatest(0, least(b.y + b.h, r.y + r.h) - greatest(b.y, r.y)) >= 0.05::DOUBLE * least(greatest(1, b.w * b.h), greatest(1, r.w * r.h))
  OR abs(b.x + b.w / 2.0::DOUBLE - r.x - r.w / 2.0::DOUBLE) + abs(b.y + b.h / 2.0::DOUBLE - r.y - r.h / 2.0::DOUBLE) <= 1.4::DOUBLE * greatest(1, b.w, b.h, r.w, r.h) GROUP BY 1, 2, 3"""


@query(f"WITH {FIXTURES}, {_REGIONS} {_NEAR}")
def seal_region_match(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return spatial.first_match(L.blocks(docs), _regions(docs), spatial.near_region)


@query(f"WITH {FIXTURES} SELECT * FROM tables")
def table_union_bbox(spark, sf_dir):
    return L.tables(_docs(spark, sf_dir)).select(*PAGE, *SIDES)


@query(f"""WITH {FIXTURES}, c AS (SELECT doc_id, page_index, row_index, col_index, {ONE.format("text")} AS t FROM cells WHERE {ONE.format("text")} <> ''),
r AS (SELECT doc_id, page_index, row_index, string_agg(t, ' | ' ORDER BY col_index, t) AS line FROM c GROUP BY 1, 2, 3)
SELECT doc_id, page_index, string_agg(line, chr(10) ORDER BY row_index) AS text FROM r GROUP BY 1, 2""")
def table_plain_text(spark, sf_dir):
    return tables.table_text(L.cells(_docs(spark, sf_dir)))


@query(f"WITH {FIXTURES} SELECT doc_id, page_index, text, x, y, w, h, 'table_cell' AS block_type, row_index, col_index FROM cells WHERE trim(text) <> ''")
def cells_to_text_blocks(spark, sf_dir):
    return tables.cells_as_blocks(L.cells(_docs(spark, sf_dir))).select(*PAGE, "text", *SIDES, "block_type", "row_index", "col_index")


@query(f"""WITH {FIXTURES} SELECT doc_id, page_index, 0 AS kind, line_no, text, x, y, w, h FROM blocks b WHERE NOT EXISTS (
  SELECT 1 FROM tables t WHERE t.doc_id = b.doc_id AND t.page_index = b.page_index AND {_INSIDE})
UNION ALL SELECT doc_id, page_index, 2, row_index * 1000 + col_index, text, x, y, w, h FROM cells WHERE trim(text) <> ''""")
def merge_refined_tables(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return tables.merge_refined(L.blocks(docs), L.tables(docs), L.cells(docs)).select(*PAGE, "kind", "line_no", "text", *SIDES)


@query(f"""WITH {FIXTURES}, e AS (SELECT DISTINCT doc_id, page_index, {ONE.format("text")} AS k, x, y, w, h FROM blocks),
r AS (SELECT doc_id, page_index, line_no, text, x, y, w, h FROM blocks UNION ALL SELECT doc_id, page_index, 1000 + row_index * 1000 + col_index, text, x, y, w, h FROM cells),
c AS (SELECT doc_id, page_index, {ONE.format("text")} AS k, x, y, w, h, min(line_no) AS line_no, arg_min(text, line_no) AS text FROM r GROUP BY 1, 2, 3, 4, 5, 6, 7)
SELECT doc_id, page_index, line_no, text, x, y, w, h FROM c ANTI JOIN e USING (doc_id, page_index, k, x, y, w, h)""")
def append_new_blocks(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    of = L.blocks(docs).select(*PAGE, "line_no", "text", "box")
    more = L.cells(docs).select(*PAGE, (1000 + F.col("row_index") * 1000 + F.col("col_index")).alias("line_no"), "text", "box")
    return tables.new_blocks(of, of.unionByName(more)).select(*PAGE, "line_no", "text", *SIDES)


@query("""WITH a AS (SELECT doc_id, 'page' AS kind, source AS uri, 0 AS part FROM documents UNION ALL SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'page' ELSE 'text' END, source, 1 FROM documents)
SELECT doc_id, kind, uri, min(part) AS part FROM a GROUP BY 1, 2, 3""")
def artifact_union(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    first = docs.select("doc_id", F.lit("page").alias("kind"), F.col("source").alias("uri"))
    second = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "page").otherwise("text").alias("kind"), F.col("source").alias("uri"))
    return tables.first_artifacts(first, second)


@query(f"""WITH {FIXTURES} SELECT doc_id, page_index, greatest(8.0::DOUBLE, median(w)::DOUBLE * 0.6::DOUBLE) AS width_tolerance, greatest(8.0::DOUBLE, median(h)::DOUBLE * 0.6::DOUBLE) AS height_tolerance
FROM blocks GROUP BY 1, 2""")
def median_tolerance(spark, sf_dir):
    of = L.blocks(_docs(spark, sf_dir))
    return of.groupBy(*PAGE).agg(tables.tolerance(F.col("box.w")).alias("width_tolerance"), tables.tolerance(F.col("box.h")).alias("height_tolerance"))


@query(f"""WITH {FIXTURES}, n AS (SELECT *, CASE WHEN length(text) < 40 THEN CAST(length(text) AS VARCHAR) ELSE text END AS t FROM blocks)
SELECT doc_id, page_index, line_no FROM n WHERE regexp_full_match(trim(t), '[0-9]{{1,4}}') AND (y + 8.0::DOUBLE <= 96.0::DOUBLE OR y + 8.0::DOUBLE >= 704.0::DOUBLE)""")
def page_number_blocks(spark, sf_dir):
    """Short lines stand for page numbers here, the texts having none."""
    of = L.blocks(_docs(spark, sf_dir))
    length = F.char_length("text")
    numbered = of.withColumn("text", F.when(length < 40, length.cast("string")).otherwise(F.col("text")))
    return numbered.where(T.strip(F.col("text")).rlike("^[0-9]{1,4}$") & G.page_margin(F.col("box"), F.lit(800.0))).select(*PAGE, "line_no")


@query(f"""WITH {FIXTURES} SELECT doc_id, page_index, max(x + w) AS width, max(y + h) AS height FROM
  (SELECT doc_id, page_index, x, y, w, h FROM blocks UNION ALL SELECT doc_id, page_index, x, y, w, h FROM cells) GROUP BY 1, 2""")
def page_extents(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return tables.extents(L.blocks(docs), L.cells(docs))


@query(f"""WITH {FIXTURES} SELECT doc_id, page_index, line_no, round_even(x * 595.0::DOUBLE / 2000.0::DOUBLE, 3) AS px0, round_even(y * 842.0::DOUBLE / 900.0::DOUBLE, 3) AS py0,
  round_even(least(595.0::DOUBLE, (x + w) * 595.0::DOUBLE / 2000.0::DOUBLE), 3) AS px1 FROM blocks""".replace("x * 595.0::DOUBLE / 2000.0::DOUBLE", "x * (595.0::DOUBLE / 2000.0::DOUBLE)").replace("y * 842.0::DOUBLE / 900.0::DOUBLE", "y * (842.0::DOUBLE / 900.0::DOUBLE)").replace("(x + w) * 595.0::DOUBLE / 2000.0::DOUBLE", "(x + w) * (595.0::DOUBLE / 2000.0::DOUBLE)"))
def pdf_rectangles(spark, sf_dir):
    rect = G.pdf_rect(F.col("box"), F.lit(2000.0), F.lit(900.0), F.lit(595.0), F.lit(842.0))
    of = L.blocks(_docs(spark, sf_dir)).select(*PAGE, "line_no", rect.alias("r"))
    return of.select(*PAGE, "line_no", F.col("r.x0").alias("px0"), F.col("r.y0").alias("py0"), F.col("r.x1").alias("px1"))


#: Blocks of pages in lines, one after another: (doc_id, page_index, line, text, x, y) in s.
_IN_LINES = f"""WITH RECURSIVE {FIXTURES}, b AS (SELECT doc_id, page_index, text, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY y, x, text) AS k FROM blocks),
s AS (SELECT doc_id, page_index, k, text, x, y, 0 AS line, y AS total, 1.0::DOUBLE AS n FROM b WHERE k = 1 UNION ALL
  SELECT b.doc_id, b.page_index, b.k, b.text, b.x, b.y, CASE WHEN abs(b.y - total / n) > 12 THEN line + 1 ELSE line END, CASE WHEN abs(b.y - total / n) > 12 THEN b.y ELSE total + b.y END, CASE WHEN abs(b.y - total / n) > 12 THEN 1.0::DOUBLE ELSE n + 1 END
  FROM s JOIN b ON b.doc_id = s.doc_id AND b.page_index = s.page_index AND b.k = s.k + 1),
placed AS (SELECT doc_id, page_index, line, CAST(row_number() OVER (PARTITION BY doc_id, page_index ORDER BY line, x, y, text) - 1 AS INT) AS place, text, x, y FROM s)"""


@query(_IN_LINES + " SELECT * FROM placed")
def reading_order(spark, sf_dir):
    return reading.reading_order(L.blocks(_docs(spark, sf_dir)))


@query(_IN_LINES + f""", o AS (SELECT doc_id, page_index, CAST(place + 1 AS BIGINT) AS n, trim(text, {BLANKS}) AS t FROM placed), {not_redundant("kept", "o", "doc_id, page_index")}
SELECT doc_id, page_index, CASE WHEN len(out) > 0 THEN array_to_string(out, chr(10)) END AS text FROM kept""")
def redundancy_filter(spark, sf_dir):
    return reading.page_text(reading.reading_order(L.blocks(_docs(spark, sf_dir))))


@query(f"""WITH {FIXTURES}, k AS (SELECT doc_id, page_index, x, y, {ONE.format("text")} AS t, replace(lower(regexp_replace({ONE.format("text")}, '[^\\p{{L}}\\p{{N}}]+', '', 'g')), 'ß', 'ss') AS k FROM blocks),
f AS (SELECT doc_id, page_index, k, min({{'y': y, 'x': x, 't': t}}) AS m FROM k WHERE k <> '' GROUP BY 1, 2, 3)
SELECT doc_id, page_index, string_agg(m.t, chr(10) ORDER BY m.y, m.x, m.t) AS text FROM f GROUP BY 1, 2""")
def page_text_distinct(spark, sf_dir):
    return reading.page_text_by_key(L.blocks(_docs(spark, sf_dir)))


@query(f"WITH {FIXTURES} SELECT doc_id, page_index, string_agg(text, chr(10) ORDER BY line_no) AS text FROM blocks GROUP BY 1, 2")
def page_text_in_order(spark, sf_dir):
    return reading.page_text_plain(L.blocks(_docs(spark, sf_dir)))


@query(f"""WITH {FIXTURES}, p AS (SELECT doc_id, page_index, string_agg(text, chr(10) ORDER BY line_no) AS text, count(*) OVER (PARTITION BY doc_id) AS pages FROM blocks GROUP BY 1, 2)
SELECT doc_id, trim(string_agg(CASE WHEN pages > 1 THEN '# Page ' || (page_index + 1) || chr(10) || chr(10) ELSE '' END || text, chr(10) || chr(10) ORDER BY page_index), ' ' || chr(9) || chr(10) || chr(13)) || chr(10) AS markdown FROM p GROUP BY 1""")
def markdown_documents(spark, sf_dir):
    return reading.markdown(reading.page_text_plain(L.blocks(_docs(spark, sf_dir))))


def _clusters(name: str, value: str, within: float) -> str:
    """Centres of clusters of a page's sorted values, as lists, in DuckDB."""
    return f"""{name}v AS (SELECT doc_id, page_index, {value} AS v, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY {value}) AS k FROM cells),
{name}s AS (SELECT doc_id, page_index, k, [v] AS centers, v AS total, 1.0::DOUBLE AS n FROM {name}v WHERE k = 1 UNION ALL
  SELECT a.doc_id, a.page_index, a.k, CASE WHEN abs(a.v - total / n) > {within} THEN list_append(centers, a.v) ELSE list_append(centers[1:len(centers) - 1], (total + a.v) / (n + 1)) END,
  CASE WHEN abs(a.v - total / n) > {within} THEN a.v ELSE total + a.v END, CASE WHEN abs(a.v - total / n) > {within} THEN 1.0::DOUBLE ELSE n + 1 END FROM {name}s s JOIN {name}v a ON a.doc_id = s.doc_id AND a.page_index = s.page_index AND a.k = s.k + 1),
{name} AS (SELECT doc_id, page_index, arg_max(centers, k) AS centers FROM {name}s GROUP BY 1, 2)"""


def _nearest(centers: str, value: str) -> str:
    far = f"list_transform({centers}, lambda c: abs(c - ({value})))"
    return f"CAST(list_position({far}, list_min({far})) - 1 AS INT)"


@query(f"""WITH RECURSIVE {FIXTURES}, {_clusters("down", "y + 8.0::DOUBLE", 9.6)}, {_clusters("across", "x + 60.0::DOUBLE", 72.0)}
SELECT c.doc_id, c.page_index, text, x, y, w, h, {_nearest("d.centers", "y + 8.0::DOUBLE")} AS row_index, {_nearest("a.centers", "x + 60.0::DOUBLE")} AS col_index FROM cells c JOIN down d USING (doc_id, page_index) JOIN across a USING (doc_id, page_index)""")
def grid_index(spark, sf_dir):
    of = L.cells(_docs(spark, sf_dir)).withColumn("table_no", F.lit(0))
    return tables.grid(of).select(*PAGE, "text", *SIDES, "row_index", "col_index")


def _shifted(df: DataFrame, by: int) -> DataFrame:
    return df.withColumn("box", G.box(F.col("box.x") + by, F.col("box.y") + 1, F.col("box.w"), F.col("box.h")))


_COMMON = "greatest(0, least({0}.x + {0}.w, {1}.x + {1}.w) - greatest({0}.x, {1}.x)) * greatest(0, least({0}.y + {0}.h, {1}.y + {1}.h) - greatest({0}.y, {1}.y))"


@query(f"""WITH RECURSIVE {FIXTURES}, m AS (SELECT doc_id, page_index, line_no, x + 5 AS x, y + 1 AS y, w, h FROM blocks),
o AS (SELECT t.doc_id, t.page_index, t.line_no AS table_no, coalesce(list(c.line_no ORDER BY c.line_no) FILTER (c.line_no IS NOT NULL), []) AS options FROM blocks t LEFT JOIN m c ON c.doc_id = t.doc_id AND c.page_index = t.page_index
  AND {_COMMON.format("t", "c")} > 0 AND {_COMMON.format("t", "c")} / (t.w * t.h + c.w * c.h - {_COMMON.format("t", "c")})::DOUBLE >= 0.7::DOUBLE GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY table_no) AS k FROM o),
s AS (SELECT doc_id, page_index, k, table_no, options[1] AS chosen, CASE WHEN len(options) > 0 THEN [options[1]] ELSE [] END AS used FROM k WHERE k = 1 UNION ALL
  SELECT n.doc_id, n.page_index, n.k, n.table_no, list_filter(n.options, lambda c: NOT list_contains(used, c))[1], list_concat(used, list_filter(n.options, lambda c: NOT list_contains(used, c))[1:1]) FROM s JOIN k n ON n.doc_id = s.doc_id AND n.page_index = s.page_index AND n.k = s.k + 1)
SELECT doc_id, page_index, table_no, chosen AS candidate_no FROM s""")
def greedy_iou_match(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    of = L.blocks(docs)
    return spatial.greedy_match(of.withColumnRenamed("line_no", "table_no"), _shifted(of, 5).withColumnRenamed("line_no", "candidate_no"))


@query(f"""WITH RECURSIVE {FIXTURES}, a AS (SELECT doc_id, page_index, line_no, text, x, y, w, h FROM blocks UNION ALL SELECT doc_id, page_index, line_no + 100000, text, x + 3, y + 1, w, h FROM blocks),
b AS (SELECT *, replace(lower(regexp_replace({ONE.format("text")}, '[^\\p{{L}}\\p{{N}}]+', '', 'g')), 'ß', 'ss') AS key FROM a),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_index, key ORDER BY y, x, text, line_no) AS k FROM b WHERE key <> ''),
s AS (SELECT doc_id, page_index, key, k, line_no, text, x, y, w, h, true AS kept, [{{'x': x, 'y': y, 'w': w, 'h': h}}] AS had FROM k WHERE k = 1 UNION ALL
  SELECT n.doc_id, n.page_index, n.key, n.k, n.line_no, n.text, n.x, n.y, n.w, n.h, len(list_filter(had, lambda q: {_COMMON.format("n", "q")} / least(greatest(1, n.w * n.h), greatest(1, q.w * q.h))::DOUBLE >= 0.5::DOUBLE)) = 0,
  CASE WHEN len(list_filter(had, lambda q: {_COMMON.format("n", "q")} / least(greatest(1, n.w * n.h), greatest(1, q.w * q.h))::DOUBLE >= 0.5::DOUBLE)) = 0 THEN list_append(had, {{'x': n.x, 'y': n.y, 'w': n.w, 'h': n.h}}) ELSE had END
  FROM s JOIN k n ON n.doc_id = s.doc_id AND n.page_index = s.page_index AND n.key = s.key AND n.k = s.k + 1)
SELECT doc_id, page_index, line_no, text, x, y, w, h FROM s WHERE kept""".replace("\\\\", "\\"))
def dedupe_overlapping_blocks(spark, sf_dir):
    of = L.blocks(_docs(spark, sf_dir))
    again = _shifted(of, 3).withColumn("line_no", F.col("line_no") + 100000)
    return reading.dedupe_blocks(of.unionByName(again)).select(*PAGE, "line_no", "text", *SIDES)


@query(f"""WITH {FIXTURES}, {_REGIONS}, m AS (SELECT r.doc_id, r.page_index, r.ordinal, r.x, r.y, r.w, r.h, min(b.line_no) AS onto FROM (SELECT doc_id, page_index, ordinal, x, y, 400 AS w, h FROM regions) r LEFT JOIN blocks b ON b.doc_id = r.doc_id AND b.page_index = r.page_index
  AND {_COMMON.format("b", "r")} / least(greatest(1, b.w * b.h), greatest(1, r.w * r.h))::DOUBLE >= 0.12::DOUBLE GROUP BY 1, 2, 3, 4, 5, 6, 7),
f AS (SELECT a.doc_id, a.page_index, b.ordinal, a.ordinal AS first FROM m a JOIN m b ON a.doc_id = b.doc_id AND a.page_index = b.page_index AND a.ordinal < b.ordinal WHERE a.onto IS NULL AND b.onto IS NULL
  AND {_COMMON.format("a", "b")} / least(greatest(1, a.w * a.h), greatest(1, b.w * b.h))::DOUBLE >= 0.12::DOUBLE)
SELECT b.doc_id, b.page_index, b.line_no, b.text, b.x, b.y, b.w, b.h, coalesce(string_agg(m.ordinal, ',' ORDER BY m.ordinal), '') AS marks FROM blocks b LEFT JOIN m ON m.doc_id = b.doc_id AND m.page_index = b.page_index AND m.onto = b.line_no GROUP BY 1, 2, 3, 4, 5, 6, 7, 8
UNION ALL SELECT m.doc_id, m.page_index, -m.ordinal - 1, 'seal', m.x, m.y, m.w, m.h, coalesce((SELECT string_agg(f.ordinal, ',' ORDER BY f.ordinal) FROM f WHERE f.doc_id = m.doc_id AND f.page_index = m.page_index AND f.first = m.ordinal), '')
FROM m WHERE m.onto IS NULL AND NOT EXISTS (SELECT 1 FROM f WHERE f.doc_id = m.doc_id AND f.page_index = m.page_index AND f.ordinal = m.ordinal)""")
def annotated_blocks(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    marks = _regions(docs).withColumn("text", F.lit("seal"))
    return spatial.annotate(L.blocks(docs), marks).select(*PAGE, "line_no", "text", *SIDES, F.array_join(F.col("marks").cast("array<string>"), ",").alias("marks"))


def _recognised(of: DataFrame) -> DataFrame:
    """Recognised texts near the blocks, one word short."""
    return _shifted(of, 4).select(*PAGE, F.col("line_no").alias("ordinal"), F.regexp_replace("text", " [^ ]*$", "").alias("text"), "box", F.lit(0.95).alias("confidence"))


@query()
def near_duplicate_blocks(spark, sf_dir):
    of = L.blocks(_docs(spark, sf_dir))
    return spatial.confirmed(of, _recognised(of))


@query()
def merged_artifact_text(spark, sf_dir):
    of = L.blocks(_docs(spark, sf_dir)).withColumn("confidence", F.lit(0.8))
    return merge_artifact_text(of, _recognised(of)).select(*PAGE, "line_no", "text", *SIDES, "origin")


@query(f"""WITH {FIXTURES},
words AS (SELECT k AS keyword, {KEY.format("k")} AS word_key FROM (VALUES {_WORDS}) v(k)),
hits AS (SELECT doc_id, page_index, line_no, keyword FROM blocks JOIN words ON contains({KEY.format("text")}, word_key))
SELECT doc_id, page_index, keyword, count(*) AS n FROM hits GROUP BY 1, 2, 3""")
def keyword_counts(spark, sf_dir):
    of = search.searchable(L.blocks(_docs(spark, sf_dir)), "mineru_text_block")
    return search.matches(of, search.keyword_table(spark, KEYWORDS)).groupBy(*PAGE, "keyword").agg(F.count("*").alias("n"))
