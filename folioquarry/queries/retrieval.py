"""Queries on retrieval, rules and keywords in great numbers, and answers under a budget."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..operators import answers, retrieval, search, spans
from ..operators.reading import page_text_plain
from ..operators.spatial import PAGE
from ..sources import layout_text as L
from ..sources.files import read_table
from .registry import FIXTURES, KEY, Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _docs(spark, sf_dir):
    return L.read_documents(spark, sf_dir)


def _items(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


_TERMS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


@query(f"""WITH {FIXTURES}, t AS (SELECT doc_id, page_index, unnest({_TERMS.format("text")}) AS term FROM blocks),
n AS (SELECT doc_id, page_index, count(*) AS n FROM t GROUP BY 1, 2), s AS (SELECT count(*) AS pages, sum(n) / count(*)::DOUBLE AS mean FROM n),
tf AS (SELECT doc_id, page_index, term, count(*) AS tf FROM t GROUP BY 1, 2, 3), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
q AS (SELECT DISTINCT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark),
c AS (SELECT item_id, doc_id, page_index, round(sum(ln(1.0::DOUBLE + (pages - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / mean)))), 6) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN n USING (doc_id, page_index), s GROUP BY 1, 2, 3),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, page_index) AS INT) AS place FROM c)
SELECT item_id AS query_id, place, doc_id, page_index, score FROM r WHERE place <= 10""")
def page_retrieval(spark, sf_dir):
    """The ten best pages of the documents for each item of the benchmark."""
    index = retrieval.build(page_text_plain(L.blocks(_docs(spark, sf_dir))))
    return retrieval.search(index, _items(spark, sf_dir).select(F.col("item_id").alias("query_id"), "text"), k=10)


#: Words of seven letters at least in the benchmark's items: several hundred.
_WORDS = "SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]{7,}')) AS word FROM benchmark"


def _words(spark, sf_dir):
    return _items(spark, sf_dir).select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{7,}"), F.lit(0))).alias("word")).distinct()


@query(f"""WITH {FIXTURES}, p AS (SELECT doc_id, page_index, string_agg(text, chr(10) ORDER BY line_no) AS text FROM blocks GROUP BY 1, 2),
w AS ({_WORDS}), h AS (SELECT doc_id, page_index, word, string_split(text, word) AS parts FROM p JOIN w ON contains(text, word)),
k AS (SELECT doc_id, page_index, word, parts, unnest(range(1, len(parts))) AS k FROM h)
SELECT doc_id, page_index, word AS matched_text, 'length ' || length(word) AS category, 'agent-' || length(word) % 3 AS agent_id, 'lexicon' AS hit_origin,
  CAST(list_sum(list_transform(parts[1:k], lambda x: length(x))) + (k - 1) * length(word) AS INT) AS char_start FROM k""")
def rule_hits(spark, sf_dir):
    """A rule for every long word of the benchmark, found on all pages in one pass."""
    n = F.char_length("word")
    rules = _words(spark, sf_dir).select("word", F.col("word").alias("rule_id"), F.concat(F.lit("length "), n.cast("string")).alias("rule_tag"), F.concat(F.lit("agent-"), (n % 3).cast("string")).alias("agent_id"))
    hits = spans.rule_hits(page_text_plain(L.blocks(_docs(spark, sf_dir))), rules)
    return hits.select(*PAGE, "matched_text", "category", "agent_id", "hit_origin", "char_start")


@query(f"""WITH {FIXTURES}, w AS (SELECT DISTINCT lower(word) AS word FROM ({_WORDS})), k AS (SELECT doc_id, page_index, line_no, {KEY.format("text")} AS key FROM blocks)
SELECT word AS keyword, count(*) AS lines, count(DISTINCT doc_id) AS documents FROM k JOIN w ON contains(key, word) GROUP BY 1""")
def many_keywords(spark, sf_dir):
    """Hundreds of keywords, in all lines of all documents."""
    words = _words(spark, sf_dir).select(F.lower("word").alias("keyword")).distinct().withColumn("key", F.col("keyword"))
    found = search.matches(L.blocks(_docs(spark, sf_dir)), words)
    return found.groupBy("keyword").agg(F.count("*").alias("lines"), F.countDistinct("doc_id").alias("documents"))


def _length(texts: pd.Series) -> pd.Series:
    return texts.str.len().astype(str)


_MODEL = answers.Model("length", "1", _length, prompt="How long is this?", output_schema="string")
_PARTS = ("'length'", "'1'", "'How long is this?'", "'string'", "text")
_PRINT = "sha256(" + " || ".join(f"strlen({p}) || ':' || {p}" for p in _PARTS) + ")"


@query(f"""WITH a AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations), i AS (SELECT *, {_PRINT} AS fingerprint, CAST(len(regexp_extract_all(text, '\\S+')) AS BIGINT) AS cost FROM a),
r AS (SELECT fingerprint, max(cost) AS cost, CAST(min(least(turn, 2)) AS INT) AS priority FROM i GROUP BY 1),
w AS (SELECT *, sum(cost) OVER (ORDER BY priority, fingerprint) AS running, (SELECT sum(cost) FROM r) AS total FROM r)
SELECT conv_id, turn, CASE WHEN running <= total // 3 THEN 'cache' ELSE 'deferred' END AS origin, CASE WHEN running <= total // 3 THEN CAST(length(text) AS VARCHAR) END AS answer FROM i JOIN w USING (fingerprint)""".replace("\\\\", "\\"))
def budgeted_answers(spark, sf_dir):
    """The turns of all conversations, first turns first, up to a third of all words; then again with what was answered, for nothing."""
    turns = read_table(spark, f"{sf_dir}/conversations.parquet").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    inputs = turns.withColumn("cost", F.size(F.regexp_extract_all("text", F.lit(r"[^ \t\n\x0c\r]+"), F.lit(0)))).withColumn("priority", F.least("turn", F.lit(2)).cast("int"))
    total = answers.open_requests(inputs, None, _MODEL).agg(F.sum("cost")).first()[0] or 0
    _, cache = answers.serve(inputs, None, _MODEL, budget=total // 3)
    rows, _ = answers.serve(inputs, cache, _MODEL, budget=0)
    return rows.select("conv_id", "turn", "origin", "answer")
