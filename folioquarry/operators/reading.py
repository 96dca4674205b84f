"""Reading order, redundancy and page texts.

These rules depend on what came before on the page, so each page is folded in order with ``aggregate``
over its array of blocks: a page is one row, and the fold stays in the JVM.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from .base import ROWS_OUT
from .spatial import PAGE

TOLERANCE = 12.0
#: Items of an inner fold: what a fold adds to its result is copied with the rest of it, so that of long pages only the parts are.
PART = 256


def fold_rows(items: Column, state: Column, step, row: str) -> Column:
    """The rows that a fold makes, one for each item: ``step(state, item)`` is (next state, row). ``row`` is the type of a row.

    Parts of the items are folded each into an array of its own, so the work is linear in the items.
    """
    none, parts = F.array().cast(f"array<{row}>"), F.array().cast(f"array<array<{row}>>")

    def inner(acc: Column, item: Column) -> Column:
        after, made = step(acc["state"], item)
        return F.struct(after.alias("state"), F.array_append(acc["rows"], made).alias("rows"))

    def outer(acc: Column, k: Column) -> Column:
        part = F.aggregate(F.slice(items, k * PART + 1, F.lit(PART)), F.struct(acc["state"].alias("state"), none.alias("rows")), inner)
        return T.let(part, lambda p: F.struct(p["state"].alias("state"), F.array_append(acc["parts"], p["rows"]).alias("parts")))

    count = F.ceil(F.size(items) / PART).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.aggregate(numbers, F.struct(state.alias("state"), parts.alias("parts")), outer, lambda acc: acc["parts"]))


def reading_order(blocks: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, page_index, line, place, text, x, y): lines gather blocks within ``tolerance`` of the line's running mean.

    Blocks come by (y, x, text) and start a new line when they are further off; within a line they are
    ordered by (x, y, text).
    """
    entry = F.struct(F.col("box.y").cast("double").alias("y"), F.col("box.x").cast("double").alias("x"), "text")
    pages = blocks.groupBy(*PAGE).agg(F.array_sort(F.collect_list(entry)).alias("items"))
    rows = pages.select(*PAGE, F.posexplode(in_lines(F.col("items"), tolerance)).alias("place", "b"))
    return rows.select(*PAGE, "b.line", "place", "b.text", "b.x", "b.y")


def in_lines(items: Column, tolerance: float = TOLERANCE, **more: str) -> Column:
    """struct<line, x, y, text> of a page's struct<y, x, text>, which are sorted, in reading order; ``more`` are fields that they have besides, with their types."""
    start = F.struct(F.lit(-1).alias("line"), F.lit(0.0).alias("total"), F.lit(0.0).alias("n"))

    def step(acc: Column, b: Column) -> tuple[Column, Column]:
        new = (acc["n"] == 0) | (F.abs(b["y"] - acc["total"] / acc["n"]) > tolerance)
        line = F.when(new, acc["line"] + 1).otherwise(acc["line"])
        after = F.struct(line.alias("line"), F.when(new, b["y"]).otherwise(acc["total"] + b["y"]).alias("total"), F.when(new, F.lit(1.0)).otherwise(acc["n"] + 1.0).alias("n"))
        return after, F.struct(line.alias("line"), b["x"].alias("x"), b["y"].alias("y"), b["text"].alias("text"), *[b[c].alias(c) for c in more])

    kinds = {"line": "int", "x": "double", "y": "double", "text": "string"} | more
    return F.array_sort(fold_rows(items, start, step, f"struct<{', '.join(f'{c}: {kind}' for c, kind in kinds.items())}>"))


def _kept(keys: list[str], units: list[list[str]], least: float) -> list[int]:
    """Places of a page's texts that those kept before them do not make redundant."""
    out: list[int] = []
    whole: set[str] = set()
    said: set[str] = set()
    holders: list[str] = []  # keys kept that are long enough to count as parts or to have such parts
    for i, key in enumerate(keys):
        if key == "" or key in whole:
            continue
        n, own = len(key), set(units[i])
        if n >= T.HELD and any(key in k if n <= len(k) else k in key for k in holders):
            continue
        if own and said and len(own & said) / len(own) >= least:
            continue
        out.append(i)
        whole.add(key)
        said |= own
        if n >= T.HELD:
            holders.append(key)
    return out


def not_redundant(items: Column, least: float = 0.82) -> Column:
    """D3, F8: of an array of struct<text, key, units>, in order, the texts that those kept so far do not make redundant.

    Redundant is an empty key, one that equals or holds a kept key or is held by it (12 characters at
    least), or units of which ``least`` are among the kept ones'. Only keys and units go to Python, whose sets do not copy what was kept for each text.
    """

    def places(keys: pa.Array, units: pa.Array) -> pa.Array:
        found: list[list[int]] = []
        for at in range(0, len(keys), ROWS_OUT):
            some = zip(keys.slice(at, ROWS_OUT).to_pylist(), units.slice(at, ROWS_OUT).to_pylist(), strict=True)
            found += [_kept(k, u, least) for k, u in some]
        return pa.array(found, pa.list_(pa.int32()))

    # one that counts as not deterministic is not computed again by a filter that is pushed down
    kept = F.arrow_udf(places, "array<int>").asNondeterministic()
    return F.transform(kept(F.transform(items, lambda b: b["key"]), F.transform(items, lambda b: b["units"])), lambda i: items[i]["text"])


def page_text(ordered: DataFrame) -> DataFrame:
    """(doc_id, page_index, text): the texts of a page in reading order without redundant ones; null if nothing is left."""
    own = T.let(T.canonical(F.col("text")), lambda t: F.struct(t.alias("text"), T.key_and_units(t).alias("said")))
    entry = F.struct("place", "own.text", "own.said.key", "own.said.units")
    pages = ordered.select(*PAGE, "place", own.alias("own")).groupBy(*PAGE).agg(F.array_sort(F.collect_list(entry)).alias("items"))
    return pages.select(*PAGE, F.nullif(F.array_join(not_redundant(F.col("items")), "\n"), F.lit("")).alias("text"))


def page_text_by_key(blocks: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Page text of blocks (and table texts) by position, one of each key: the first by (y, x), blocks before tables."""
    rows = blocks.select(*PAGE, F.lit(0).alias("kind"), "box", T.squeeze(F.col("text")).alias("text"))
    if tables is not None:
        rows = rows.unionByName(tables.select(*PAGE, F.lit(1).alias("kind"), "box", T.squeeze(F.col("text")).alias("text")))
    entry = F.struct("kind", F.col("box.y").alias("y"), F.col("box.x").alias("x"), "text", "key")
    # a page's rows are few, so that repeats are told within its array, and no row is sorted for it
    pages = rows.withColumn("key", T.word_key(F.col("text"))).groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.when(F.col("key") != "", entry))).alias("items"))

    def first_of_each(items: Column) -> Column:
        keys = F.transform(items, lambda e: e["key"])
        return T.let(keys, lambda ks: F.filter(items, lambda e, i: F.array_position(ks, e["key"]) == i + 1))

    placed = F.array_sort(F.transform(T.let(F.col("items"), first_of_each), lambda e: F.struct(e["y"].alias("y"), e["x"].alias("x"), e["text"].alias("text"))))
    return pages.where(F.size("items") > 0).select(*PAGE, F.array_join(F.transform(placed, lambda e: e["text"]), "\n").alias("text"))


def page_text_plain(blocks: DataFrame, ordinal: str = "line_no") -> DataFrame:
    """Page text of blocks in input order."""
    entry = F.struct(ordinal, "text")
    shown = blocks.where(T.strip(F.col("text")) != "")
    return shown.groupBy(*PAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"]), "\n").alias("text"))


def dedupe_blocks(blocks: DataFrame, least: float = 0.5) -> DataFrame:
    """Blocks by (y, x, text), without those whose key equals that of a kept block that they overlap.

    Only blocks of one key can meet, so the fold runs over a page's blocks of one key.
    """
    keyed = blocks.withColumn("key", T.word_key(F.col("text")))
    entry = F.struct(F.col("box.y").alias("y"), F.col("box.x").alias("x"), "text", "line_no", "box")
    # blocks without a key give no entry; a filter by the key would be pushed down and compute it again
    same = keyed.groupBy(*PAGE, "key").agg(F.array_sort(F.collect_list(F.when(F.col("key") != "", entry))).alias("items"))
    kind = "array<struct<y: int, x: int, text: string, line_no: int, box: struct<x: int, y: int, w: int, h: int>>>"

    def step(acc: Column, b: Column) -> Column:
        return F.when(F.exists(acc, lambda k: G.overlap(k["box"], b["box"]) >= least), acc).otherwise(F.array_append(acc, b))

    kept = same.select(*PAGE, F.explode(F.aggregate("items", F.array().cast(kind), step)).alias("b"))
    return kept.select(*PAGE, "b.line_no", "b.text", "b.box")


def markdown(pages: DataFrame) -> DataFrame:
    """One Markdown text per document: its pages in order, each under its number if there are several, with a line feed at the end."""
    page = F.struct("page_index", F.coalesce("text", F.lit("")).alias("text"))
    documents = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(page)).alias("pages"))
    return documents.select("doc_id", markdown_of(F.col("pages")).alias("markdown"))


def markdown_of(pages: Column) -> Column:
    """The Markdown text of an array of struct<page_index, text> in order."""
    title = lambda p: F.when(F.size(pages) > 1, F.concat(F.lit("# Page "), (p["page_index"] + 1).cast("string")))
    chunks = F.flatten(F.transform(pages, lambda p: F.array_compact(F.array(title(p), F.when(p["text"] != "", p["text"])))))
    return F.concat(T.strip(F.array_join(chunks, "\n\n")), F.lit("\n"))
