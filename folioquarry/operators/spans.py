"""Sensitive spans from a lexicon, and their roll-up per document (derived from the row contracts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import patterns
from .spatial import PAGE

# Names of risk types, brought to one.
RISK_TYPES = {"id": "identity", "identity": "identity", "phone": "contact", "contact": "contact", "email": "contact", "secret": "credential", "password": "credential", "credential": "credential"}


def lexicon(spark: SparkSession, words: dict[str, str]) -> DataFrame:
    """(word, risk_type) of the caller's list."""
    return spark.createDataFrame([(w, r) for w, r in words.items()], "word string, risk_type string")


def risk_type(name: Column) -> Column:
    """R5"""
    out = F.lit("other")
    for given, one in RISK_TYPES.items():
        out = F.when(F.lower(F.trim(name)) == given, F.lit(one)).otherwise(out)
    return out


def job_documents(jobs: DataFrame) -> DataFrame:
    """One row per source path of a job, blank paths left out."""
    paths = jobs.select("archive_id", "job_id", "triggered_by_user_id", F.posexplode("source_paths").alias("ordinal", "file_uri"))
    return paths.where(F.trim("file_uri") != "").withColumn("doc_id", F.concat_ws("-", "job_id", "ordinal"))


def gate(pages: DataFrame, words: DataFrame) -> DataFrame:
    """Pages that hold any word of the lexicon at all, before anything costly runs on them."""
    return patterns.holding(pages, words)


def lexicon_spans(pages: DataFrame, words: DataFrame) -> DataFrame:
    """R2: every occurrence of a word in a page's text: character range (end exclusive), quote and risk type; a word of several types has a row for each.

    The occurrences come from one pass over the texts; types are then joined to them by the word.
    """
    found = patterns.occurrences(pages.select(*PAGE, "text"), words, keep_text=False)
    typed = found.join(words.where("word <> ''").select("word", "risk_type"), "word")
    return typed.select(*PAGE, F.col("word").alias("quote"), "risk_type", "char_start", "char_end")


def rule_hits(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The hits of a rules table (``files.read_rules``: rule_id, rule_tag, word and, if there is one, agent_id) in pages' texts.

    (doc_id, page_index, matched_text, category, rule_id, agent_id, hit_origin, char_start, char_end): the category is the rule's tag, the agent the
    one that the rule names; the origin of a word of a list is ``lexicon``. A word of several rules hits for each of them.
    """
    found = patterns.occurrences(pages.select(*PAGE, "text"), rules, keep_text=False)
    agent = F.col("agent_id").cast("string") if "agent_id" in rules.columns else F.lit(None).cast("string")
    named = rules.where("word <> ''").select("word", "rule_id", F.col("rule_tag").alias("category"), agent.alias("agent_id")).distinct()
    return found.join(named, "word").select(
        *PAGE, F.col("word").alias("matched_text"), "category", "rule_id", "agent_id", F.lit("lexicon").alias("hit_origin"), "char_start", "char_end"
    )


def document_result(spans: DataFrame) -> DataFrame:
    """Spans and pages with spans per document, and the number of each risk type."""
    return spans.groupBy("doc_id").agg(
        F.count("*").alias("span_count"), F.countDistinct("page_index").alias("page_count"), F.countDistinct("quote").alias("word_count"),
        F.count_if(F.col("risk_type") == "credential").alias("credential_count"),
    )


def merge_hits(rule_hits: DataFrame, model_hits: DataFrame) -> DataFrame:
    """Rule hits win over model hits of the same range; origin says which one stayed."""
    key = [*PAGE, "char_start", "char_end"]
    rest = model_hits.join(rule_hits.select(*key).distinct(), key, "left_anti")
    return rule_hits.withColumn("origin", F.lit("rule")).unionByName(rest.withColumn("origin", F.lit("model")))


def orphans(spans: DataFrame, documents: DataFrame, *keys: str) -> DataFrame:
    """Spans whose keys no document has; empty if all is well."""
    return spans.join(documents.select(*keys).distinct(), list(keys), "left_anti")
