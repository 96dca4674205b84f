"""Recognition of tables by a pluggable reader, run by Spark: bounded batches, one error row a failed item, a second pass, and outcomes by document. C2, C6, C7, C8, Z3

A reader is an object that is made once a worker (``Reader.start`` loads what is costly) and is given items in batches of bounded bytes. A
batch that fails is tried item by item, so one bad picture costs one row. Items are pictures of tables (crops), or of whole pages, as the mode says.

Documents first pass the gate (``refine.refine_gate``). Crops of which the first reader failed, or found fewer cells than their html has, are read by the
second reader if there is one, and by no other way again: the second pass reads those keys only. A document with an item that failed for good is
warned (its pages stay as they are) or failed, as its options say; nothing of it is merged.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from . import tables
from .base import checkpointed
from .refine import PROVIDERS, refine_gate, refine_outcome
from .spatial import PAGE

#: Bytes of pictures, and items, that a reader is given at once. A larger picture comes alone.
BATCH_BYTES, BATCH_ITEMS = 16 << 20, 64
# Modes that read crops of tables, and the names of both ways.
CROP_MODES = ("table_structure", "table_structure_recognition", "mineru_crops")
BY_CROPS, BY_PAGES = "table_structure", "ppstructurev3"
#: Page items have this number; those of crops count from 0.
WHOLE_PAGE = -1

CELL = "struct<row_index: int, col_index: int, text: string, box: struct<x: int, y: int, w: int, h: int>, confidence: double>"
FOUND = f"table_no int, box struct<x: int, y: int, w: int, h: int>, html string, cells array<{CELL}>, raw string, error struct<code: string, message: string>"


class Reader:
    """Reads tables off pictures. Subclasses take plain options and are sent to the workers by pickle."""

    provider = "paddleocr_ppstructurev3"

    def start(self) -> None:
        """Called once a worker, before the first batch."""

    def read(self, items: list[dict[str, Any]]) -> list[list[dict[str, Any]]]:
        """The tables of each item: dicts of box, html, cells (row_index, col_index, text, box, confidence) and, if wanted, raw (a text).

        An item has the columns of the input; ``content`` is the picture's bytes.
        """
        raise NotImplementedError


class TextReader(Reader):
    """A reader without a model: pictures are UTF-8 texts, every line with `` | `` a row of one table; a text that holds ``refuses`` cannot be read, and the last ``loses`` cells are not seen."""

    def __init__(self, loses: int = 0, refuses: str | None = None, provider: str = "text") -> None:
        self.loses, self.refuses, self.provider = loses, refuses, provider

    def read(self, items: list[dict[str, Any]]) -> list[list[dict[str, Any]]]:
        out = []
        for item in items:
            text = bytes(item["content"]).decode("utf-8")
            if self.refuses and self.refuses in text:
                raise ValueError("cannot be read")
            rows = [line.split(" | ") for line in text.split("\n") if " | " in line]
            cells = [
                {"row_index": r, "col_index": c, "text": t, "box": {"x": 10 + 120 * c, "y": 20 * r, "w": 120, "h": 16}, "confidence": 1.0}
                for r, row in enumerate(rows) for c, t in enumerate(row)
            ]
            kept = cells[: len(cells) - self.loses]
            box = {"x": 10, "y": 0, "w": 120 * max(map(len, rows)), "h": 20 * len(rows)} if rows else None
            out.append([{"box": box, "html": None, "cells": kept, "raw": f"{len(rows)} rows"}] if rows else [])
        return out


@dataclass(frozen=True)
class Options:
    """What a run does with its documents; a document's ``mode`` column, if there is one, goes before ``mode``."""

    enabled: bool = True
    mode: str | None = None
    provider: str = PROVIDERS[0]
    only_with_tables: bool = True
    force: bool = False
    fail_open: bool = True
    emit_cells: bool = True
    replace: bool = True


@dataclass(frozen=True)
class Refined:
    """``outcomes``: a row per document; ``tables``: a row per table with its cells and what the reader said (Z3); ``blocks``: those of all pages, merged."""

    outcomes: DataFrame
    tables: DataFrame
    blocks: DataFrame


def chosen_mode(given: Column, has_candidates: Column) -> Column:
    """``BY_CROPS`` or ``BY_PAGES``: what the mode says, or, without one, crops where there are candidates."""
    mode = F.nullif(F.lower(F.trim(F.coalesce(given, F.lit("")))), F.lit(""))
    return F.when(F.coalesce(mode.isin(*CROP_MODES), has_candidates), F.lit(BY_CROPS)).otherwise(F.lit(BY_PAGES))


_started: dict[tuple[type, bytes], Reader] = {}


def _ready(reader: Reader) -> Reader:
    """The worker's own reader of this type and these options, started."""
    import pickle

    key = (type(reader), pickle.dumps(reader.__dict__))
    if key not in _started:
        reader.start()
        _started[key] = reader
    return _started[key]


def _batches_of(items: list[dict[str, Any]]):
    some, size = [], 0
    for item in items:
        n = len(item["content"] or b"")
        if some and (size + n > BATCH_BYTES or len(some) == BATCH_ITEMS):
            yield some
            some, size = [], 0
        some.append(item)
        size += n
    if some:
        yield some


def _tables_of(reader: Reader, items: list[dict[str, Any]]) -> list[list[dict[str, Any]] | Exception]:
    try:
        found = reader.read(items)
        if len(found) != len(items):
            raise ValueError(f"{len(items)} items, {len(found)} results")
        return list(found)
    except Exception as e:
        return [e] if len(items) == 1 else [x for item in items for x in _tables_of(reader, [item])]


def recognise(items: DataFrame, reader: Reader, *keys: str) -> DataFrame:
    """(keys, table_no, box, html, cells, raw, error): a row per table that the reader finds in an item (keys, content and whatever it needs), or one row with an error.

    Pictures are dropped in the worker; nothing after it carries them.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([*[items.schema[k] for k in keys], *T.StructType.fromDDL(FOUND).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        own = None
        for batch in batches:
            own = own or _ready(reader)
            for some in _batches_of(batch.to_pylist()):
                out = []
                for item, found in zip(some, _tables_of(own, some), strict=True):
                    key = {k: item[k] for k in keys}
                    if isinstance(found, Exception):
                        code = getattr(found, "code", "READ_FAILED")
                        out.append(key | {"table_no": None, "box": None, "html": None, "cells": None, "raw": None, "error": {"code": code, "message": f"{type(found).__name__}: {found}"}})
                    else:
                        out += [key | {"table_no": n, "box": t.get("box"), "html": t.get("html"), "cells": t.get("cells") or [], "raw": t.get("raw"), "error": None} for n, t in enumerate(found)]
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return items.mapInArrow(run, schema)


def _short(found: DataFrame, items: DataFrame, *keys: str) -> DataFrame:
    """The keys of items that failed, or of which fewer cells were found than their html has."""
    had = found.groupBy(*keys).agg(F.coalesce(F.sum(F.size("cells")), F.lit(0)).alias("had"), F.bool_or(F.col("error").isNotNull()).alias("failed"))
    wanted = items.select(*keys, F.coalesce(F.size(F.regexp_extract_all("html", F.lit(X.CELL), F.lit(0))), F.lit(0)).alias("wanted"))
    both = wanted.join(had, list(keys), "left")
    return both.where(F.coalesce("failed", F.lit(False)) | (F.coalesce("had", F.lit(0)) < F.col("wanted"))).select(*keys)


def two_passes(items: DataFrame, first: Reader, second: Reader | None, *keys: str) -> DataFrame:
    """What the first reader finds, or, for items that it failed at or read too little of, what the second finds if that is more; ``fallback`` tells which.

    Both passes are written before they are used, so that no picture is read twice.
    """
    found = checkpointed(recognise(items, first, *keys)).withColumn("fallback", F.lit(False))
    if second is None:
        return found
    poor = checkpointed(_short(found, items, *keys))
    again = checkpointed(recognise(items.join(poor, list(keys), "left_semi"), second, *keys)).withColumn("fallback", F.lit(True))
    size = lambda df, name: df.groupBy(*keys).agg(F.bool_or(F.col("error").isNotNull()).alias(f"{name}_failed"), F.coalesce(F.sum(F.size("cells")), F.lit(0)).alias(name))
    both = poor.join(size(found, "had"), list(keys), "left").join(size(again, "got"), list(keys), "left")
    more = F.col("got").isNotNull() & ~F.coalesce("got_failed", F.lit(False)) & (F.coalesce("had_failed", F.lit(False)) | (F.col("got") > F.coalesce("had", F.lit(0))))
    better = both.where(more).select(*keys)
    return found.join(better, list(keys), "left_anti").unionByName(again.join(better, list(keys), "left_semi"))


def refine(documents: DataFrame, blocks: DataFrame, candidates: DataFrame, pages: DataFrame, options: Options, by_crop: Reader, by_page: Reader, second: Reader | None = None) -> Refined:
    """The pages of documents with their tables refined.

    ``documents``: doc_id and, if there is one, mode; ``blocks``: keys, line_no, text, box; ``candidates``: keys, candidate_no, box, html, content (null: no
    picture, F7); ``pages``: keys, content. The provider is checked before anything runs.
    """
    if options.provider not in PROVIDERS:
        raise ValueError(f"TABLE_CELL_REFINEMENT_PROVIDER_UNSUPPORTED: {options.provider}")
    given = F.coalesce("mode", F.lit(options.mode)) if "mode" in documents.columns else F.lit(options.mode).cast("string")
    counted = documents.select("doc_id", given.alias("given")).join(candidates.groupBy("doc_id").agg(F.count("*").alias("n_candidates")), "doc_id", "left")
    gate = refine_gate(F.lit(options.enabled), F.col("n_candidates"), F.lit(options.force), F.col("given"), F.lit(options.only_with_tables))
    gated = checkpointed(counted.select("doc_id", chosen_mode(F.col("given"), F.coalesce("n_candidates", F.lit(0)) > 0).alias("mode"), gate.alias("gate")))
    todo = lambda mode: gated.where(F.col("gate") & (F.col("mode") == mode)).select("doc_id")
    keys = [*PAGE, "item_no"]
    crops = candidates.where("content IS NOT NULL").withColumnRenamed("candidate_no", "item_no").join(todo(BY_CROPS), "doc_id", "left_semi").select(*keys, "box", "html", "content")
    whole = pages.where("content IS NOT NULL").join(todo(BY_PAGES), "doc_id", "left_semi").select(*PAGE, F.lit(WHOLE_PAGE).alias("item_no"), "content")
    of_crops = two_passes(crops, by_crop, second, *keys)
    # a crop's table lies where its candidate does
    of_crops = of_crops.drop("box").join(crops.select(*keys, "box"), keys, "left").select(*of_crops.columns)
    of_pages = checkpointed(recognise(whole, by_page, *keys)).withColumn("fallback", F.lit(False))
    every = of_crops.withColumn("provider", F.lit(by_crop.provider)).unionByName(of_pages.withColumn("provider", F.lit(by_page.provider)))
    errors = every.where("error IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct("page_index", "item_no", "error"))["error"].alias("error"))
    told = gated.join(errors, "doc_id", "left")
    outcome = refine_outcome(F.col("gate"), F.lit(options.enabled), F.lit(options.provider), F.col("error.code"), F.lit(options.fail_open))
    outcomes = told.select("doc_id", "mode", outcome.alias("outcome"), "error")
    merged = outcomes.where("outcome = 'merged'").select("doc_id")
    kept = every.where("error IS NULL").join(merged, "doc_id", "left_semi")
    number = F.when(F.col("item_no") == WHOLE_PAGE, F.col("table_no")).otherwise(F.col("item_no") + F.col("table_no") * 10_000)
    of = kept.select(*PAGE, number.alias("table_no"), "box", "html", "provider", "fallback", "cells", "raw")
    cells = of.select(*PAGE, F.explode("cells").alias("c")).select(*PAGE, "c.row_index", "c.col_index", "c.text", "c.box")
    return Refined(outcomes, of, tables.merge_refined(blocks, of, cells, emit_cells=options.emit_cells, replace=options.replace))


def write_artifacts(refined: Refined, path: str) -> DataFrame:
    """The artifacts as JSON lines below ``path``, in one folder a run, and (doc_id, kind, uri, table_count, cell_count, content_type) that refer to them."""
    made = artifact(refined)
    made.write.mode("errorifexists").parquet(path)
    v = F.parse_json("json")
    count = lambda name: F.try_variant_get(v, f"$.{name}", "bigint").alias(name)
    read = made.sparkSession.read.parquet(path)
    return read.select("doc_id", F.lit("paddle_table_json").alias("kind"), F.concat(F.lit(path.rstrip("/") + "#"), F.col("doc_id").cast("string")).alias("uri"), count("table_count"), count("cell_count"), F.lit("application/json").alias("content_type"))


def artifact(refined: Refined) -> DataFrame:
    """Z3: one JSON per document with a recognised table: normalised tables by page, and what the readers said, in order."""
    table = F.struct("table_no", "box", "html", "cells")
    page = refined.tables.groupBy(*PAGE).agg(F.array_sort(F.collect_list(table), lambda a, b: a["table_no"] - b["table_no"]).alias("tables"))
    by_page = page.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("page_index").cast("string").alias("page_index"), "tables")), lambda a, b: F.when(a["page_index"].cast("int") < b["page_index"].cast("int"), -1).otherwise(1))).alias("tables_by_page"))
    raw = refined.tables.groupBy("doc_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("page_index", "table_no", F.coalesce("raw", F.lit("")).alias("raw")))), lambda r: r["raw"]).alias("raw_results"),
        F.count("*").alias("table_count"), F.sum(F.size("cells")).alias("cell_count"), F.min("provider").alias("provider"),
    )
    both = raw.join(by_page, "doc_id")
    return both.select("doc_id", F.to_json(F.struct("provider", "table_count", "cell_count", "tables_by_page", "raw_results")).alias("json"))
