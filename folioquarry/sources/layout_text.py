"""Layout rows of plain texts: every line a block with a box, ``|`` separated lines as table cells.

A deterministic stand-in for an external layout model. Each derivation is a projection and an explode
of one text, so the scan reads two columns and nothing shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import box, union_box
from .files import read_table

LINES_A_PAGE = 40


def blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, page_index, line_no, text, box) of the lines that are not blank."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text")).where(F.trim("text") != "")
    i, d = F.col("line_no"), F.col("doc_id")
    jitter = (d * 7 + i * 3) % 9
    place = box((10 + (i % 2) * 300).cast("int"), ((i % LINES_A_PAGE) * 20 + jitter).cast("int"), (F.char_length("text") * 8).cast("int"), F.lit(16))
    return lines.select("doc_id", F.floor(i / LINES_A_PAGE).cast("int").alias("page_index"), "line_no", "text", place.alias("box"))


def cells(docs: DataFrame) -> DataFrame:
    """(doc_id, page_index, row_index, col_index, text, box) of the lines with ``|``."""
    # most texts have no such line and are not split
    of = blocks(docs.where(F.col("text").contains(" | "))).where(F.col("text").contains(" | "))
    parts = of.select("doc_id", "page_index", F.col("line_no").alias("row_index"), "box", F.posexplode(F.split("text", " \\| ")).alias("col_index", "text"))
    place = box(F.col("box.x") + F.col("col_index") * 120, F.col("box.y"), F.lit(120), F.lit(16))
    return parts.select("doc_id", "page_index", "row_index", "col_index", "text", place.alias("box"))


def tables(docs: DataFrame) -> DataFrame:
    """(doc_id, page_index, box): the box around a page's cells."""
    return cells(docs).groupBy("doc_id", "page_index").agg(union_box(F.col("box")).alias("box"))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet")
