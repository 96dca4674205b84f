"""Compositions of operators: whole-document plans."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract as X
from ..operators import reading, report, search, tables
from ..operators.fusion import merge_artifact_text
from ..sources import layout_text as L

__all__ = ["batch_plan", "document_plan", "document_results_plan", "field_search_plan", "merge_artifact_text", "pages_from_models", "read_results", "run_documents"]


def field_search_plan(spark: SparkSession, docs: DataFrame, keywords: list[str]) -> DataFrame:
    """C5 over documents: blocks and cells, searched and deduplicated."""
    return search.field_search(L.blocks(docs), L.cells(docs), search.keyword_table(spark, keywords))


def batch_plan(docs: DataFrame, done: DataFrame | None = None, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Pages and per-document results of the documents that earlier results lack."""
    tasks = docs if done is None else report.pending(docs, done, "doc_id")
    tasks = tasks.orderBy("doc_id").limit(limit) if limit and limit > 0 else tasks
    pages = X.extract(tasks)
    return pages, X.file_results(pages, tasks)


def document_plan(docs: DataFrame) -> DataFrame:
    """C11: page texts of documents in reading order, tables merged."""
    blocks, cells, found = L.blocks(docs), L.cells(docs), L.tables(docs)
    merged = tables.merge_refined(blocks, found, cells)
    return reading.page_text(reading.reading_order(merged))


def pages_from_models(layout: DataFrame, lines: DataFrame, marks: DataFrame) -> DataFrame:
    """Blocks of pages from layout regions, OCR lines and seal or formula marks.

    A region's text is that of the lines centred in it (each line belongs to the first region, by line_no), or its
    own; tables are left out; lines in no region are blocks of their own; equal overlapping blocks are one; marks are
    put on blocks or appended. ``layout``: keys, line_no, label, text, box; ``lines``: keys, line_no, text, box,
    confidence; ``marks``: keys, ordinal, text, box.
    """
    from ..functions import geometry as G
    from ..functions import text as T
    from ..operators.base import checkpointed
    from ..operators.spatial import PAGE, annotate, fill_cells, outside

    regions = layout.where("label <> 'table'").withColumnRenamed("line_no", "cell_no")
    filled = fill_cells(regions.select(*PAGE, "cell_no", "box"), lines, shown=T.squeeze)
    own = regions.join(filled.select(*PAGE, "cell_no", F.col("text").alias("found")), [*PAGE, "cell_no"], "left")
    blocks = own.select(*PAGE, F.col("cell_no").alias("line_no"), F.coalesce("found", T.squeeze(F.col("text"))).alias("text"), "box").where("text <> \'\'")
    free = outside(lines, regions.select(*PAGE, "box"), G.center_inside).select(*PAGE, (F.col("line_no") + 1_000_000).cast("int").alias("line_no"), "text", "box")
    # marks are put on blocks that are then read again, so these are computed once
    return annotate(checkpointed(reading.dedupe_blocks(blocks.unionByName(free))), marks)


def document_results_plan(docs: DataFrame, keywords: DataFrame | None = None, recognised: DataFrame | None = None, cells: DataFrame | None = None, tables_: DataFrame | None = None) -> DataFrame:
    """C11: one result per document (doc_id, error_code, page_count, block_count, cell_count, markdown, match_count, result), by all steps of a single-document run.

    Pages are extracted (failed documents keep their error and nothing else), recognised texts are merged into their blocks (C3), all texts are
    corrected (T1), blocks in tables give way to cells (C1), page texts are composed anew in reading order (O2, A11, C4), Markdown is rendered (K11), keywords are located
    (C5), and a tree of pages with their blocks is put together (P7, K1). Documents are extracted once. ``docs``: doc_id, text; ``recognised`` as candidates of ``merge_artifact_text``; ``cells`` and
    ``tables_``: cells and boxes of tables by page.
    """
    from ..functions import geometry as G
    from ..functions import text as T
    from ..operators.spatial import PAGE

    box = "struct<x: int, y: int, w: int, h: int>"
    kinds = {"n": "int", "code": "string", "blocks": f"array<struct<line_no: int, text: string, box: {box}>>", "cells": f"array<struct<line_no: int, text: string, box: {box}, shown: boolean>>", "tables": f"array<{box}>"}

    def rows(of: DataFrame, **given: Column) -> DataFrame:
        return of.select(*PAGE, *[given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()])

    pages, good = X.extract(docs), F.col("error").isNull()
    parts = [rows(pages, n=good.cast("int"), code=F.col("error.code"), **({} if recognised is not None else {"blocks": F.col("blocks")}))]
    if recognised is not None:
        own = pages.where(good).select(*PAGE, F.explode("blocks").alias("b")).select(*PAGE, "b.line_no", "b.text", "b.box", F.lit(None).cast("double").alias("confidence"))
        parts.append(rows(merge_artifact_text(own, recognised), blocks=F.array(F.struct("line_no", "text", "box"))))
    if tables_ is not None and cells is not None:
        shown = F.col("box").isNotNull() & (T.strip(T.correct(F.col("text"))) != "")
        cell = F.struct((F.col("row_index") * 1000 + F.col("col_index")).alias("line_no"), "text", "box", F.coalesce(shown, F.lit(False)).alias("shown"))
        parts += [rows(cells, cells=F.array(cell)), rows(tables_, tables=F.array("box"))]

    # all that is known of a page meets in one shuffle; what is made of it is then made in its row
    whole = [F.flatten(F.collect_list(c)).alias(c) for c in ("blocks", "cells", "tables")]
    page = reduce(DataFrame.unionByName, parts).groupBy(*PAGE).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.min("code").alias("code"), *whole)

    def keyed(b: Column) -> Column:
        """A block with the keys of its text, which are computed here and in no later step. What is sought is another key only where corrections may correct again."""

        def told(t: Column, own: Column, k: Column) -> Column:
            sought = F.when(t.contains("盖率") | t.contains("号"), T.match_key(t)).otherwise(k["key"])
            return F.struct(b["line_no"].alias("line_no"), b["box"].alias("box"), t.alias("text"), own.alias("own"), k["key"].alias("key"), k["units"].alias("units"), sought.alias("sought"))

        return T.let(T.correct(b["text"]), lambda t: T.let(T.canonical(t), lambda own: T.let(T.key_and_units(own), lambda k: told(t, own, k))))

    page = page.select(*PAGE, "n", "code", "tables", F.transform("blocks", keyed).alias("blocks"), F.transform("cells", lambda c: keyed(c).withField("shown", c["shown"])).alias("cells"))
    keyed_page = page
    said = lambda c: keyed_page.select(*PAGE, F.explode(c).alias("b")).select(*PAGE, "b.text", "b.box")
    fields = ("line_no", "text", "box", "own", "key", "units")
    entry = lambda kind: lambda b: F.struct(F.lit(kind).alias("kind"), *[b[c].alias(c) for c in fields])
    inside = lambda b: F.exists("tables", lambda t: F.coalesce(G.center_inside(b["box"], t), F.lit(False)))
    body = F.when(F.size("tables") > 0, F.filter("blocks", lambda b: ~inside(b))).otherwise(F.col("blocks"))
    merged = F.array_sort(F.concat(F.transform(body, entry(0)), F.transform(F.filter("cells", lambda c: c["shown"]), entry(2))))
    listed = search.listed(keywords) if keywords is not None else []
    few = len(listed) <= search.FEW
    matched = F.lit(0) if not few else search.matches_of_page(F.col("blocks"), F.col("cells"), listed)
    page = page.select(*PAGE, "n", "code", matched.alias("matches"), merged.alias("merged"))
    more = {"own": "string", "key": "string", "units": "array<string>"}
    places = F.transform("merged", lambda b: F.struct(b["box"]["y"].cast("double").alias("y"), b["box"]["x"].cast("double").alias("x"), *[b[c].alias(c) for c in ("text", *more)]))
    page = page.select("*", F.array_sort(places).alias("places"))
    ordered = F.transform(reading.in_lines(F.col("places"), **more), lambda b: F.struct(b["own"].alias("text"), b["key"].alias("key"), b["units"].alias("units")))
    blocks = F.transform("merged", lambda b: F.struct(*[b[c].alias(c) for c in ("kind", "line_no", "text", "box")]))
    page = page.select(*PAGE, "n", "code", "matches", F.when(F.size("merged") > 0, blocks).alias("blocks"), ordered.alias("items"))
    page = page.withColumn("kept", reading.not_redundant(F.col("items")))
    page = page.select(*PAGE, "n", "code", "matches", "blocks", F.nullif(F.array_join("kept", "\n"), F.lit("")).alias("text"))

    held = F.flatten(F.collect_list(F.array_repeat(F.struct("page_index", "text", "blocks"), F.col("n").cast("int"))))
    tree = page.groupBy("doc_id").agg(
        F.min("code").alias("error_code"), F.array_sort(held).alias("pages"), F.sum("n").alias("page_count"),
        F.sum(F.col("n") * F.coalesce(F.size("blocks"), F.lit(0))).alias("block_count"),
        F.sum(F.col("n") * F.coalesce(F.size(F.filter("blocks", lambda b: b["kind"] == 2)), F.lit(0))).alias("cell_count"), F.sum("matches").alias("match_count"),
    )
    every = docs.select("doc_id").join(tree, "doc_id", "left")
    if not few:
        found = search.field_search(said("blocks"), said("cells"), keywords).groupBy("doc_id").agg(F.count("*").alias("match_count"))
        every = every.drop("match_count").join(found, "doc_id", "left")
    ok = F.col("error_code").isNull()
    number = lambda c: F.coalesce(F.when(ok, F.col(c)), F.lit(0)).cast("bigint").alias(c)
    written = F.when(F.size("pages") > 0, reading.markdown_of(F.transform("pages", lambda p: F.struct(p["page_index"].alias("page_index"), F.coalesce(p["text"], F.lit("")).alias("text")))))
    pages_ = F.when(F.size("pages") > 0, F.col("pages"))
    return every.select(
        "doc_id", "error_code", number("page_count"), number("block_count"), number("cell_count"), F.when(ok, written).alias("markdown"), number("match_count"),
        F.when(ok, F.to_json(F.struct("doc_id", F.nullif("page_count", F.lit(0)).alias("page_count"), pages_.alias("pages")))).alias("result"),
    )


def run_documents(docs: DataFrame, path: str, plan=document_results_plan, rounds: int = 8) -> list[str]:
    """Results of the documents that ``path`` lacks, written round by round; returns the rounds written.

    A round is a slice of the documents by a hash of their id. Its results are written first, then the ids that they are of: only these
    commit them, so a run that ends half way leaves results that nobody reads, and the next run works the documents again whose ids were not written. Documents that
    failed are committed with their error; delete their round's ids to have them tried again.
    """
    spark = docs.sparkSession
    done, written = committed(spark, path), []
    for k in range(rounds):
        part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == k)
        todo = part if done is None else report.pending(part, done, "doc_id")
        if todo.isEmpty():
            continue
        name = uuid.uuid4().hex
        plan(todo).write.parquet(f"{path}/results/round={name}")
        spark.read.parquet(f"{path}/results/round={name}").select("doc_id").write.parquet(f"{path}/ledger/round={name}")
        written.append(name)
    return written


def committed(spark: SparkSession, path: str) -> DataFrame | None:
    """(doc_id, round) of the documents whose results count; None if nothing was ever committed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/ledger")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    return spark.read.schema("doc_id bigint, round string").parquet(f"{path}/ledger")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The results of ``run_documents`` that were committed."""
    done = committed(spark, path)
    if done is None:
        raise FileNotFoundError(f"{path} holds no committed results")
    return spark.read.parquet(f"{path}/results").join(done, ["doc_id", "round"], "left_semi").drop("round")
