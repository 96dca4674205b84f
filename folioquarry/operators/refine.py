"""Refinement of pages and tables: table blocks with fallbacks, seals, html as a source of cell texts, and wire formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..functions.jsontree import map_strings
from .reading import not_redundant
from .spatial import PAGE, confirmed, first_match, greedy_match, near_region


# Modes that need no table, and who can refine.
MODES_WITHOUT_TABLES = ("auto", "paddle3_auto", "paddle_auto", "ppocrv5", "pp_ocrv5", "paddleocr", "ocr", "paddleocr_vl", "paddleocrvl", "vl")
PROVIDERS = ("paddleocr", "paddleocr_ppstructurev3")


def refine_gate(enabled: Column, tables: Column, forced: Column, mode: Column, only_with_tables: Column | None = None) -> Column:
    """whether a document is refined: it is enabled, and there are tables, or it is forced, or its mode (``auto`` unless given) or setting needs none."""
    chosen = F.lower(F.trim(F.coalesce(F.nullif(F.trim(mode), F.lit("")), F.lit("auto"))))
    needs = F.coalesce(only_with_tables, F.lit(True)) if only_with_tables is not None else F.lit(True)
    anyway = F.coalesce(forced, F.lit(False)) | chosen.isin(*MODES_WITHOUT_TABLES) | ~needs
    return F.coalesce(enabled, F.lit(False)) & (anyway | (F.coalesce(tables, F.lit(0)) > 0))


def refine_outcome(gate: Column, enabled: Column, provider: Column, error: Column, fail_open: Column | None = None) -> Column:
    """What becomes of a document's refinement: off, skipped, unsupported, warned (the error is noted and the pages stay), failed or merged."""
    known = F.coalesce(F.nullif(F.trim(provider), F.lit("")), F.lit(PROVIDERS[0])).isin(*PROVIDERS)
    open_ = F.coalesce(fail_open, F.lit(True)) if fail_open is not None else F.lit(True)
    return (
        F.when(~F.coalesce(enabled, F.lit(False)), F.lit("off")).when(~gate, F.lit("skipped")).when(~known, F.lit("unsupported"))
        .when(error.isNull(), F.lit("merged")).when(open_, F.lit("warned")).otherwise(F.lit("failed"))
    )


def table_blocks(raw: DataFrame, candidates: DataFrame) -> DataFrame:
    """(doc_id, page_index, table_no, table_id, box, html, candidate_no): a page's raw tables with their candidates, or, on pages without one, its candidates.

    ``raw``: keys, table_no, box, html; ``candidates``: keys, candidate_no, box, html.
    """
    matched = raw.join(greedy_match(raw, candidates), [*PAGE, "table_no"], "left").select(*PAGE, "table_no", "box", "html", "candidate_no")
    free = candidates.join(raw.select(*PAGE).distinct(), [*PAGE], "left_anti")
    fallback = free.select(*PAGE, F.col("candidate_no").alias("table_no"), "box", F.lit(None).cast("string").alias("html"), "candidate_no")
    return matched.unionByName(fallback).select(*PAGE, "table_no", F.format_string("p%d-mineru-t%d", "page_index", "table_no").alias("table_id"), "box", "html", "candidate_no")


def annotate_seals(blocks: DataFrame, regions: DataFrame, texts: DataFrame) -> DataFrame:
    """Seal blocks with the region that they belong to and whether a recognised text confirms them; a block that is not confirmed is not rendered."""
    of = first_match(blocks, regions, near_region)
    sure = confirmed(blocks, texts).withColumn("confirmed", F.lit(True))
    joined = blocks.join(of, [*PAGE, "line_no"], "left").join(sure, [*PAGE, "line_no"], "left")
    return joined.withColumn("confirmed", F.coalesce("confirmed", F.lit(False))).withColumn("render_text", F.col("region").isNull() | F.col("confirmed"))


def rendered(blocks: DataFrame) -> DataFrame:
    """blocks that are not marked as not to be rendered."""
    return blocks.where(F.coalesce("render_text", F.lit(True)))


def marked(pages: DataFrame, warning: str | None, code: str | None = None) -> DataFrame:
    """Pages with the outcome of a refinement that failed or was skipped."""
    mark = F.struct(F.lit(True).alias("enabled"), F.lit(warning is None).alias("skipped"), F.lit(code).cast("string").alias("code"), F.lit(warning).cast("string").alias("warning"))
    return pages.withColumn("table_cell_refine", mark)


def replace_texts(blocks: DataFrame, recognised: DataFrame, tables: DataFrame) -> DataFrame:
    """On pages with recognised texts and no table, these take the place of the blocks."""
    pages = recognised.select(*PAGE).distinct().join(tables.select(*PAGE).distinct(), [*PAGE], "left_anti")
    kept = blocks.join(pages, [*PAGE], "left_anti").withColumn("origin", F.lit("own"))
    return kept.unionByName(recognised.join(pages, [*PAGE], "left_semi").withColumn("origin", F.lit("recognised")))


def fill_from_html(cells: DataFrame, html: DataFrame, *keys: str) -> DataFrame:
    """Cells without a text take that of the html cell in the same place of the grid, if the html has as many cells.

    ``cells``: keys, row_index, col_index, text; ``html``: keys, html. The order of the grid is rows, then columns.
    """
    every = T.cell_texts(F.col("html"))
    body = [c for c in cells.columns if c not in keys]
    grid = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("row_index", "col_index", *[c for c in body if c not in ("row_index", "col_index")]))).alias("cells"))
    both = grid.join(html.select(*keys, every.alias("texts")), list(keys), "left")
    fit = F.size("texts") == F.size("cells")
    rows = both.select(*keys, "texts", fit.alias("fit"), F.posexplode("cells").alias("at", "c"))
    blank = F.coalesce(T.strip(F.col("c.text")), F.lit("")) == ""
    filled = F.when(blank & F.col("fit"), F.try_element_at("texts", F.col("at") + 1)).otherwise(F.col("c.text"))
    source = F.when(blank & F.col("fit"), F.lit("mineru_table_html")).otherwise(F.lit("own"))
    return rows.select(*keys, *[F.col(f"c.{c}") for c in body if c != "text"], filled.alias("text"), source.alias("text_source"))


def pipe_table(html: Column, entities=T.unescape) -> Column:
    """An html table as a Markdown pipe table, the first row as its head; rows without cells vanish."""

    def rendered_(rows: Column) -> Column:
        line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, lambda x: F.replace(x, F.lit("|"), F.lit("\\|"))), " | "), F.lit(" |"))
        rule = F.concat(F.repeat(F.lit("| --- "), F.size(rows[0])), F.lit("|"))
        body = F.transform(F.slice(rows, 2, F.size(rows)), line)
        return F.when(F.size(rows) > 0, F.array_join(F.concat(F.array(line(rows[0]), rule), body), "\n"))

    return T.let(T.table_texts(html, entities), rendered_)


def column_lines(ordered: DataFrame, page_middle: Column) -> DataFrame:
    """Lines in reading order; the left and the right half of a line are joined by `` | ``, blocks within a half by a space."""
    half = F.when(F.col("x") < page_middle, 0).otherwise(1)
    halves = ordered.groupBy(*PAGE, "line", half.alias("half")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda e: e["text"]), " ").alias("text"))
    return halves.groupBy(*PAGE, "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("half", "text"))), lambda e: e["text"]), " | ").alias("text"))


def table_text_distinct(cells: DataFrame, *keys: str) -> DataFrame:
    """A10: rows of a table as lines, without cells that their row and rows that the table make redundant; cells by column, then x.

    Cells with a text but without a row are rows 0, 1, 2 and so on, in order of cell_no if there is one, else of place; a row of that number takes them in.
    """
    keys = keys or PAGE
    own = T.canonical(F.col("text"))
    place = F.struct("cell_no") if "cell_no" in cells.columns else F.struct("box.y", "box.x")
    shown = cells.withColumn("text", own).where("text <> ''").select(*keys, "row_index", F.coalesce("col_index", F.lit(10_000)).alias("c"), F.col("box.x").alias("x"), "text", place.alias("place"))
    loose = shown.where("row_index is null").withColumn("row_index", F.row_number().over(Window.partitionBy(*keys).orderBy("place", "text")) - 1)
    numbered = shown.where("row_index is not null").select(*keys, "row_index", "c", "x", "text").unionByName(loose.select(*keys, "row_index", "c", "x", "text"))
    unit = lambda t: (T.match_key(t).alias("key"), T.similarity_units(t).alias("units"))
    rows = numbered.groupBy(*keys, "row_index").agg(F.array_sort(F.collect_list(F.struct("c", "x", "text", *unit(F.col("text"))))).alias("items"))
    lines = rows.select(*keys, "row_index", F.array_join(not_redundant(F.col("items")), " ").alias("text")).where("text <> ''")
    whole = lines.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("row_index", "text", *unit(F.col("text"))))).alias("items"))
    return whole.select(*keys, F.array_join(not_redundant(F.col("items")), "\n").alias("text"))


def page_counts(tables: DataFrame) -> DataFrame:
    """Tables, tables with html and cells of each page; ``tables``: keys, html, cells (array)."""
    return tables.groupBy(*PAGE).agg(F.count("*").alias("table_count"), F.count("html").alias("html_count"), F.coalesce(F.sum(F.size("cells")), F.lit(0)).alias("cell_count"))


def to_wire(tables: DataFrame) -> DataFrame:
    """(doc_id, json) with the tables of a document keyed by page number as a string, in order of table_id."""
    entry = F.struct(*[c for c in tables.columns if c not in PAGE])
    page = tables.groupBy(*PAGE).agg(F.array_sort(F.collect_list(entry)).alias("tables"))
    return page.groupBy("doc_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("page_index").cast("string"), "tables"))))).alias("json"))


def from_wire(wires: DataFrame, entry: str) -> DataFrame:
    """The rows of ``to_wire``; keys that are no page numbers are left out. ``entry`` is the DDL of one table."""
    pages = wires.select("doc_id", F.explode(F.from_json("json", f"map<string, array<struct<{entry}>>>")).alias("page", "tables"))
    rows = pages.select("doc_id", V.as_int(F.col("page")).alias("page_index"), F.explode("tables").alias("t")).where("page_index is not null")
    return rows.select("doc_id", "page_index", "t.*")


def screenshot_manifest(documents: DataFrame, folder: str, dpi: int) -> DataFrame:
    """One row per page of a document (doc_id, num_pages, file_uri): where its picture goes, at which resolution."""
    if dpi <= 0:
        raise ValueError("dpi must be positive")
    pages = documents.where("num_pages > 0").select("doc_id", F.col("file_uri").alias("source_pdf"), F.explode(F.expr("sequence(1, num_pages)")).alias("page_number"))
    path = F.concat(F.lit(folder.rstrip("/") + "/"), F.col("doc_id").cast("string"), F.format_string("/page-%04d.png", "page_number"))
    return pages.select("doc_id", (F.col("page_number") - 1).alias("page_index"), "page_number", path.alias("image_path"), "source_pdf", F.lit(dpi).alias("dpi"))


def correct_json(value: Column) -> Column:
    """A VARIANT with the text correction applied to all of its strings, at any depth; keys and everything else stay."""
    return map_strings(value, T.correct)


# Artifacts that are read by machines and stay as they are.
MACHINE_READ = r"(^|/)paddle_table_structure\.json$|\.field_coordinates\.json$|\.error\.json$"


def rewrite_texts(files: DataFrame, exclude: str = MACHINE_READ) -> DataFrame:
    """(path, text) with readable artifacts corrected; paths that match ``exclude`` stay as they are."""
    readable = F.col("path").rlike("(?i)\\.(md|json)$") & ~F.col("path").rlike(exclude)
    return files.select("path", F.when(readable, T.correct(F.col("text"))).otherwise(F.col("text")).alias("text"))


def xml_safe(text: Column) -> Column:
    """Without characters that XML forbids."""
    return F.regexp_replace(text, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\ufffe\\uffff]", "")


def page_of_tasks(tasks: DataFrame, offset: int, limit: int | None, *order: str) -> DataFrame:
    """A window of task rows in a given order."""
    rows = tasks.orderBy(*order).offset(max(0, offset))
    return rows.limit(limit) if limit and limit > 0 else rows
