"""A corpus pipeline over ``documents``: five stages, each written as Parquet and read by the next.

Language ID drops documents in which no language can be told; line dedup deletes later copies of
repeated line runs and the documents that this leaves without words; the n-gram Jaccard join keeps
one document of each group of near duplicates; mixing takes sources to their target weights, rows
repeated as often as they are taken; encoding adds the pieces of every text.

Defined results, of ``run`` and of each stage as its operator has them: rows with a null or empty text, or one without letters, have no language and go; null sources are a source, and null
labels are not learned from; rows without an id are never near duplicates of others, and are mixed like all; of repeated rows of one id all stay until they are mixed; ties
go to the least id, and among rows of one id to their contents; texts of any length are worked whole; an empty table gives no rows, with the same columns; extra columns are handed on,
those named as a stage's own columns too (only the last stage's ``ids`` replaces one).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioquarry.llm.common import WORD, delete, shared_dir
from folioquarry.llm.op01_language import UNDETERMINED, identify, learn
from folioquarry.llm.op02_jaccard import first_of_components
from folioquarry.llm.op05_sentencepiece import encode
from folioquarry.llm.op06_mixing import mix
from folioquarry.llm.op10_line_dedup import dedup_lines


def _filtered(docs: DataFrame, work: Callable[[DataFrame], DataFrame], *added: str) -> DataFrame:
    """``work(docs)`` with the columns of ``docs`` only; own columns named as those that it adds are kept apart meanwhile."""
    apart = {c: f"_own_{c}" for c in added if c in docs.columns}
    out = work(docs.withColumnsRenamed(apart)).drop(*added)
    return out.withColumnsRenamed({v: k for k, v in apart.items()}).select(*docs.columns)


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a language can be told, as they are."""
    return _filtered(docs, lambda d: identify(d, learn(d)).where(F.col("lang_pred") != UNDETERMINED), "lang_pred", "score")


def dedup_line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; documents that lost all of their words go, others without words stay."""
    return _filtered(docs, lambda d: dedup_lines(d).where((F.col("removed_lines") == 0) | F.col("text").rlike(WORD)), "removed_lines")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; documents without words, or without an id, stay."""
    return first_of_components(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as its source's target takes it, which may be not at all."""
    return mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with the pieces of its text; a null text has none."""
    return encode(docs)


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", dedup_line_runs),
    ("jaccard_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Language ID and encoding cannot be put in SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's table is deleted when the next is written, and the last of them stays for the lazy result to read."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/folioquarry/{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
