"""Small tables with the rows that break things: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (doc_id, text, lang, source)."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], SCHEMA)


def awkward() -> list[tuple]:
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    return [
        (1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "en", None), (4, "one two", "en", "b"), (4, "one two", "en", "b"),
        (5, long, "de", "b"), (6, "1234 !!! ###", "fr", "a"), (None, "no id here at all", None, None), (7, "é 日本語 \U0001f600 x", "fr", ""),
        (8, "nospace" * 3000, "es", "b"), (9, "one two", "en", "a"),
    ]


#: Names of working columns, as extra columns of an input.
CLASHES = ["size", "h", "times", "blob", "spans", "row", "_row", "rank", "seq", "n", "lang_pred", "score", "slot", "shard", "ids", "removed_lines", "host", "t", "text_hash", "_hash", "component_id"]


def clashing(df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    for name in CLASHES:
        df = df.withColumn(name, F.lit("mine"))
    return df
