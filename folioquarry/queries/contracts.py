"""Queries on contract checks, spans, marks on blocks and pages, batch rows and task windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import geometry as G
from ..functions import text as T
from ..functions import values as V
from ..operators import extract, refine, report, search, spans, spatial, tables
from ..operators.spatial import PAGE
from ..sources import layout_text as L
from ..sources.files import read_table
from .registry import FIXTURES, KEY, ONE, Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _blocks(spark, sf_dir) -> DataFrame:
    return L.blocks(L.read_documents(spark, sf_dir))


@query("""SELECT o_orderkey, array_to_string(list_filter([
  CASE WHEN o_orderkey % 4 < 2 THEN 'V3' END, CASE WHEN o_orderkey % 5 < 2 THEN 'V4' END, CASE WHEN o_orderkey % 3 > 0 AND o_orderkey % 2 = 1 THEN 'V6' END,
  CASE WHEN o_orderkey % 7 = 2 THEN 'V8' END, CASE WHEN o_orderkey % 11 = 0 THEN 'V9' END], lambda x: x IS NOT NULL), ',') AS violations FROM orders""")
def contract_violations_of_jobs(spark, sf_dir):
    k = F.col("o_orderkey")
    paths = F.when(k % 4 == 0, F.array().cast("array<string>")).when(k % 4 == 1, F.array(F.lit("a"), F.lit(" "))).otherwise(F.array(F.lit("a"), F.lit("b")))
    uri = F.when(k % 5 == 0, "   ").when(k % 5 == 1, F.repeat(F.lit("x"), 9000)).otherwise("u")
    provenance = F.when(k % 3 > 0, F.struct((k % 2).cast("int").alias("page_index")))
    own = F.struct(F.lit("a").alias("archive_id"), k.alias("doc_id"))
    others = F.array(own, F.struct(F.lit("a").alias("archive_id"), F.when(k % 11 == 0, k + 1).otherwise(k).alias("doc_id")))
    rows = read_table(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", F.lit("a").alias("archive_id"), k.alias("doc_id"))
    checks = {
        "V3": S.paths_given(paths), "V4": S.uri_valid(uri), "V6": S.page_agrees(provenance, F.lit(0)),
        "V8": S.confirmed_whole(F.when(k % 7 < 3, "u"), F.when(k % 7 < 2, F.lit("2024-01-01").cast("timestamp"))), "V9": S.spans_belong(others, "archive_id", "doc_id"),
    }
    return S.violations(rows, checks).select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@query(f"""WITH {FIXTURES}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_index, y, x, line_no) AS k FROM (
  SELECT doc_id, page_index, line_no, x, y, w, {KEY.format("text")} AS key FROM blocks) WHERE contains(key, 'the'))
SELECT doc_id, count(*) AS match_count, string_agg(page_index || ':' || y || ':' || x || ':' || (x + w), ',' ORDER BY page_index, y, x, x + w) AS places FROM r GROUP BY 1""")
def field_coordinates(spark, sf_dir):
    """One row per document: its matches in order, with their corner points."""
    found = search.matches(search.searchable(_blocks(spark, sf_dir), "mineru_text_block"), search.keyword_table(spark, ["the"]))
    found = found.withColumn("quad_points", G.quad_points(F.col("box")))
    entry = lambda m: F.concat_ws(":", m["page_index"], m["y"], m["x"], m["quad_points"][2]["x"].cast("bigint"))
    rows = search.coordinates(found)
    return rows.select("doc_id", "match_count", F.array_join(F.transform(F.array_sort("matches", _by_end), entry), ",").alias("places"))


def _by_end(a, b):
    """Matches at one place by their right end, as the SQL has them."""
    key = lambda m: F.struct(m["page_index"], m["y"], m["x"], m["quad_points"][2]["x"])
    return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)


@query(f"""WITH {FIXTURES}, p AS (SELECT a.doc_id, a.page_index, a.line_no AS a, b.line_no AS b, a.x AS ax, a.y AS ay, a.w AS aw, a.h AS ah, b.x AS bx, b.y AS by_, b.w AS bw, b.h AS bh
  FROM blocks a JOIN blocks b ON a.doc_id = b.doc_id AND a.page_index = b.page_index AND b.line_no BETWEEN a.line_no + 1 AND a.line_no + 3),
m AS (SELECT *, greatest(0, least(ay + ah, by_ + bh) - greatest(ay, by_)) / greatest(1, least(ah, bh))::DOUBLE AS v, greatest(0, least(ax + aw, bx + bw) - greatest(ax, bx)) / greatest(1, least(aw, bw))::DOUBLE AS h,
  bx - ax - aw AS gap, greatest(0, by_ - ay - ah) AS down, greatest(48.0::DOUBLE, 2.5::DOUBLE * greatest(ah, bh)) AS reach FROM p)
SELECT doc_id, page_index, a, b, round(v, 6) AS vertical, round(h, 6) AS horizontal, v >= 0.45::DOUBLE AND gap >= -greatest(6.0::DOUBLE, least(aw, bw) * 0.5::DOUBLE) AND gap <= reach AS beside,
  by_ >= ay - greatest(4.0::DOUBLE, ah * 0.25::DOUBLE) AND down <= reach AND (h >= 0.35::DOUBLE OR abs(bx + bw / 2.0::DOUBLE - ax - aw / 2.0::DOUBLE) <= greatest(48.0::DOUBLE, 2.5::DOUBLE * greatest(aw, bw))) AS below FROM m""")
def fragment_neighbours(spark, sf_dir):
    """F12, F13, G10 for every block and the three lines that follow it."""
    of = _blocks(spark, sf_dir)
    near = lambda a, b: F.col("r.line_no").between(F.col("l.line_no") + 1, F.col("l.line_no") + 3)
    a, b = F.col("l.box"), F.col("r.box")
    return spatial.pairs(of, of, near).select(
        "l.doc_id", "l.page_index", F.col("l.line_no").alias("a"), F.col("r.line_no").alias("b"), F.round(G.vertical_overlap(a, b), 6).alias("vertical"), F.round(G.horizontal_overlap(a, b), 6).alias("horizontal"),
        G.right_on_line(a, b).alias("beside"), G.on_next_line(a, b).alias("below"),
    )


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"


@query(f"""WITH t AS (SELECT doc_id, text, text || CASE doc_id % 3 WHEN 0 THEN ' < TABLE x>' WHEN 1 THEN '<tablet>' ELSE '' END AS t FROM documents)
SELECT doc_id, trim(replace(text || ' 签字盖率 ', '签字盖率', '签字盖章'), {_WHITE}) AS canonical, regexp_matches(t, '(?i)<\\s*table\\b') AS is_table,
  regexp_replace(text || chr(7) || 'x' || chr(31), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g') AS xml_safe, list_sort(list_distinct(string_split(text, ' '))) AS words FROM t""".replace("list_sort(list_distinct(string_split(text, ' '))) AS words", "len(list_distinct(string_split(text, ' '))) AS n_words"))
def canonical_texts(spark, sf_dir):
    """T3, T21, F5, D10 on whole texts."""
    docs = L.read_documents(spark, sf_dir)
    d = F.col("doc_id") % 3
    t = F.concat("text", F.when(d == 0, " < TABLE x>").when(d == 1, "<tablet>").otherwise(""))
    return docs.select(
        "doc_id", T.canonical(F.concat("text", F.lit(" 签字盖率 "))).alias("canonical"), T.looks_like_table(t).alias("is_table"), refine.xml_safe(F.concat("text", F.lit("\x07x\x1f"))).alias("xml_safe"),
        F.size(V.sorted_distinct(F.split("text", " "))).cast("bigint").alias("n_words"),
    )


@query("""WITH d AS (SELECT s_suppkey AS index, s_name AS uuid FROM supplier), w AS (SELECT 0 AS v, '7' AS token UNION ALL SELECT 1, lower((SELECT min(s_name) FROM supplier WHERE s_suppkey = 3)) UNION ALL SELECT 2, 'none' UNION ALL SELECT 3, '1')
SELECT index, uuid, CAST(v AS INT) AS visible_index FROM d JOIN w ON token = CAST(index AS VARCHAR) OR token = lower(uuid)""")
def visible_devices(spark, sf_dir):
    """Devices by a setting of indexes and uuids, in its order."""
    devices = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("index"), F.col("s_name").alias("uuid"))
    third = devices.where("index = 3").agg(F.min("uuid")).first()[0] or "none"
    return report.visible(devices, f"7, {third.upper()},none,,1")


@query("SELECT DISTINCT event_type, CAST(event_id % 20 AS INT) AS n FROM events WHERE value > 150")
def failed_keys(spark, sf_dir):
    """F16"""
    trials = read_table(spark, f"{sf_dir}/events.parquet").select("event_type", (F.col("event_id") % 20).cast("int").alias("n"), (F.col("value") <= 150).alias("success"))
    return report.has_failure(trials, "event_type", "n")


@query("""WITH j AS (SELECT o_orderkey, unnest(['a' || o_orderkey, ' ', 'c']) AS file_uri, unnest([0, 1, 2]) AS ordinal FROM orders)
SELECT 'arch' AS archive_id, CAST(o_orderkey AS VARCHAR) AS job_id, ordinal, file_uri, o_orderkey || '-' || ordinal AS doc_id, CASE o_orderkey % 4 WHEN 0 THEN 'identity' WHEN 1 THEN 'contact' WHEN 2 THEN 'credential' ELSE 'other' END AS risk FROM j WHERE trim(file_uri) <> ''""")
def job_documents(spark, sf_dir):
    """Documents of jobs, and names of risk types brought to one."""
    k = F.col("o_orderkey")
    jobs = read_table(spark, f"{sf_dir}/orders.parquet").select(
        F.lit("arch").alias("archive_id"), k.cast("string").alias("job_id"), F.lit("u").alias("triggered_by_user_id"), F.array(F.concat(F.lit("a"), k.cast("string")), F.lit(" "), F.lit("c")).alias("source_paths")
    )
    name = F.element_at(F.array(*map(F.lit, [" ID ", "Phone", "secret", "weather"])), (F.col("job_id").cast("bigint") % 4 + 1).cast("int"))
    return spans.job_documents(jobs).select("archive_id", "job_id", "ordinal", "file_uri", "doc_id", spans.risk_type(name).alias("risk"))


@query(f"""WITH {FIXTURES}, p AS (SELECT doc_id, page_index, string_agg(text, chr(10) ORDER BY line_no) AS text FROM blocks GROUP BY 1, 2),
s AS (SELECT doc_id, page_index, length(text) % 5 AS char_start FROM p WHERE contains(text, 'password') OR contains(text, 'http')),
m AS (SELECT doc_id, page_index, char_start FROM s WHERE page_index % 2 = 0 UNION ALL SELECT doc_id, page_index, 99 FROM s)
SELECT doc_id, page_index, char_start, 'rule' AS origin, doc_id % 3 = 0 AS orphan FROM s UNION ALL SELECT doc_id, page_index, char_start, 'model', doc_id % 3 = 0 FROM m ANTI JOIN s USING (doc_id, page_index, char_start)""")
def merged_hits(spark, sf_dir):
    """Pages that hold a word of the lexicon, hits of rules before those of models, and hits whose document is not known."""
    from .pages import _pages

    some = spans.gate(_pages(spark, sf_dir), spans.lexicon(spark, {"password": "credential", "http": "contact"}))
    rules = some.select(*PAGE, (F.char_length("text") % 5).alias("char_start"), F.lit(100).alias("char_end"))
    models = rules.where("page_index % 2 = 0").unionByName(rules.withColumn("char_start", F.lit(99)))
    hits = spans.merge_hits(rules, models)
    known = L.read_documents(spark, sf_dir).where("doc_id % 3 <> 0").select("doc_id")
    lost = spans.orphans(hits, known, "doc_id").select("doc_id").distinct().withColumn("orphan", F.lit(True))
    return hits.join(lost, "doc_id", "left").select(*PAGE, "char_start", "origin", F.coalesce("orphan", F.lit(False)).alias("orphan"))


@query(f"""WITH {FIXTURES}, t AS (SELECT doc_id, page_index, count(*) AS n FROM tables GROUP BY 1, 2), p AS (SELECT doc_id, page_index, count(*) AS b, count(*) FILTER (line_no % 3 = 0 AND line_no % 2 = 0 OR line_no % 3 > 0) AS shown FROM blocks GROUP BY 1, 2)
SELECT doc_id, page_index, coalesce(n, 0) AS n_tables, shown, 'own' AS lang, 'default' AS model, doc_id % 2 = 0 AS skipped FROM p LEFT JOIN t USING (doc_id, page_index)""")
def marked_pages(spark, sf_dir):
    """Pages with their tables, the blocks that are shown, defaults of their facts, and the outcome of a refinement."""
    of = _blocks(spark, sf_dir).withColumn("render_text", F.when(F.col("line_no") % 3 == 0, F.col("line_no") % 2 == 0))
    shown = refine.rendered(of).groupBy(*PAGE).agg(F.count("*").alias("shown"))
    pages = of.select(*PAGE).distinct().join(shown, [*PAGE], "left").withColumn("shown", F.coalesce("shown", F.lit(0)))
    meta = extract.with_defaults(F.create_map(F.lit("lang"), F.lit("own")), {"lang": "none", "model": "default"})
    joined = tables.join_tables(pages, L.tables(L.read_documents(spark, sf_dir))).withColumn("meta", meta)
    even = refine.marked(joined.where("doc_id % 2 = 0"), None).unionByName(refine.marked(joined.where("doc_id % 2 <> 0"), "no model", "E1"))
    return even.select(*PAGE, "n_tables", "shown", F.col("meta")["lang"].alias("lang"), F.col("meta")["model"].alias("model"), F.col("table_cell_refine.skipped").alias("skipped"))


@query("""SELECT doc_id, '{"a":["签字盖章' || doc_id || '",{"b":"(盖章)"}],"n":' || doc_id || '}' AS json FROM documents""")
def json_corrections(spark, sf_dir):
    """Every string of open JSON corrected, at any depth."""
    d = F.col("doc_id").cast("string")
    text = F.concat(F.lit('{"a": ["签字盖率'), d, F.lit('", {"b": "(盖率)"}], "n": '), d, F.lit("}"))
    return L.read_documents(spark, sf_dir).select("doc_id", F.to_json(refine.correct_json(F.parse_json(text))).alias("json"))


@query("""WITH t AS (SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) - 1 AS n FROM customer) SELECT c_custkey, CAST(n // 64 AS INT) AS chunk, n BETWEEN 10 AND 29 AS in_window FROM t""")
def task_windows(spark, sf_dir):
    """Tasks numbered in chunks of 64, and a window of twenty of them."""
    tasks = read_table(spark, f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    window = refine.page_of_tasks(tasks, 10, 20, "c_name", "c_custkey").select("c_custkey").withColumn("in_window", F.lit(True))
    return report.chunks(tasks, ["c_name", "c_custkey"], 64).join(window, "c_custkey", "left").select("c_custkey", "chunk", F.coalesce("in_window", F.lit(False)).alias("in_window"))


@query("""SELECT 'in/' || event_id AS pdf_path, CASE WHEN event_type = 'error' THEN 'false' ELSE 'true' END AS success, '["' || event_type || '"]' AS field_keywords, CAST(event_id % 5 AS VARCHAR) AS page_count, CAST(NULL AS VARCHAR) AS json_path FROM events""")
def batch_csv_rows(spark, sf_dir):
    """K4: the fixed columns of a batch, as texts; five of them shown."""
    results = read_table(spark, f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("in/"), F.col("event_id").cast("string")).alias("pdf_path"), (F.col("event_type") != "error").alias("success"), F.array("event_type").alias("field_keywords"), (F.col("event_id") % 5).alias("page_count"), "value",
    )
    return report.batch_rows(results).select("pdf_path", "success", "field_keywords", "page_count", "json_path")


@query("""SELECT doc_id, 1 AS schema_version, 'EMPTY_DOCUMENT' AS code, '***' AS secret, 'run' AS run_id FROM documents WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) = ''
UNION ALL SELECT -doc_id - 1, 1, 'EMPTY_DOCUMENT', '***', 'run' FROM documents WHERE doc_id % 3 = 0""")
def failure_records(spark, sf_dir):
    """Records of documents that failed, every third one emptied, with secrets hidden."""
    from ..operators.base import Context

    docs = L.read_documents(spark, sf_dir).select("doc_id", "text")
    emptied = docs.where("doc_id % 3 = 0").select((-F.col("doc_id") - 1).alias("doc_id"), F.lit(" ").alias("text"))
    options = F.create_map(F.lit("api_key"), F.lit("k"))
    found = extract.failure_records(extract.extract(docs.unionByName(emptied)), Context(run_id="run"), options)
    return found.select("doc_id", "schema_version", F.col("error.code").alias("code"), F.col("options")["api_key"].alias("secret"), "run_id")


@query(f"""WITH {FIXTURES}, k AS (SELECT *, {ONE.format("text")} AS t FROM blocks), u AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY line_no) AS n, count(*) OVER (PARTITION BY doc_id, page_index) AS c FROM k)
SELECT doc_id, page_index, count(*) AS n_blocks, CAST(sum(length(t)) AS BIGINT) AS chars, round(coalesce(len(list_distinct(list(t) FILTER (n % 2 = 0))), 0) / greatest(1, len(list_distinct(list(t))))::DOUBLE, 6) AS share FROM u GROUP BY 1, 2""")
def text_coverage(spark, sf_dir):
    """The share of a page's distinct texts that its even lines hold."""
    from pyspark.sql import Window

    of = _blocks(spark, sf_dir).withColumn("t", T.squeeze(F.col("text"))).withColumn("n", F.row_number().over(Window.partitionBy(*PAGE).orderBy("line_no")))
    page = of.groupBy(*PAGE).agg(F.count("*").alias("n_blocks"), F.sum(F.char_length("t")).alias("chars"), F.collect_list("t").alias("every"), F.collect_list(F.when(F.col("n") % 2 == 0, F.col("t"))).alias("even"))
    return page.select(*PAGE, "n_blocks", "chars", F.round(V.coverage(F.col("every"), F.col("even")), 6).alias("share"))
