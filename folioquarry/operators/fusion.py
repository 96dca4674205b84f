"""Recognised texts merged into the blocks of pages.

What a text may do depends on those before it on the page, down to the similarity of sequences, so a page is folded in order,
in Arrow batches of pages. Keys, canonical texts and units are columns that the JVM computes before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .spatial import PAGE

# Least overlap of a text and the block that it is about, and least share of known units of a redundant text.
ABOUT, COVERED = 0.25, 0.82
# Block types that are never replaced, and between which lengths, relative to a block's, a text may replace it.
KEPT_TYPES, SHORTEST, SHORTEST_OF_PAGE, LONGEST = ("table_cell", "page_number"), 0.65, 0.9, 1.8
# Confidences and lengths that decide between a text and a block.
SURE_TEXT, SURE_BLOCK, LEEWAY, LONGER = 0.9, 0.85, 0.05, 2

_BOX = "struct<x: int, y: int, w: int, h: int>"
MERGED = f"doc_id bigint, page_index int, line_no int, text string, box {_BOX}, confidence double, origin string, original_text string"


def shared_area(a: dict[str, int], b: dict[str, int]) -> float:
    """Intersection over the smaller area, as ``geometry.overlap``."""
    w = min(a["x"] + a["w"], b["x"] + b["w"]) - max(a["x"], b["x"])
    h = min(a["y"] + a["h"], b["y"] + b["h"]) - max(a["y"], b["y"])
    return w * h / min(max(1, a["w"] * a["h"]), max(1, b["w"] * b["h"])) if w > 0 < h else 0.0


def replaces(text: dict[str, Any], block: dict[str, Any]) -> bool:
    """whether a recognised text takes the place of a block's: one of like length that is surer, or says more."""
    own, other = text["key"], block["key"]
    if (block["kind"] or "").strip().lower() in KEPT_TYPES or text["canonical"] == block["canonical"]:
        return False
    shortest = SHORTEST_OF_PAGE if text["whole_page"] else SHORTEST
    part = len(own) < len(other) and own in other
    if part or not shortest <= len(own) / len(other) <= LONGEST:
        return False
    sure, known = text["confidence"], block["confidence"]
    if sure is not None and (sure < SURE_TEXT if known is None else sure + LEEWAY < known):
        return False
    return len(own) >= len(other) + LONGER or (known is not None and known < SURE_BLOCK)


@dataclass
class Page:
    """The blocks of a page and what it says, as texts are merged into it; ``text`` is the key and the units of its text as a whole."""

    blocks: list[dict[str, Any]]
    text: dict[str, Any] | None = None
    keys: list[str] = field(default_factory=list)
    units: set[str] = field(default_factory=set)

    def __post_init__(self) -> None:
        for b in self.blocks:
            b |= {"origin": "kept", "original_text": None}
            self.know(b)
        if self.text:
            self.know(self.text)

    def know(self, said: dict[str, Any]) -> None:
        if said["key"]:
            self.keys.append(said["key"])
        self.units.update(said["units"])

    def says(self, text: dict[str, Any]) -> bool:
        """F8: whether a text adds nothing to what was said."""
        key, units = text["key"], set(text["units"])
        held = any(key == k or (len(key) >= T.HELD and key in k) or (len(k) >= T.HELD and k in key) for k in self.keys)
        return held or bool(units and self.units and len(units & self.units) / len(units) >= COVERED)

    def merge(self, text: dict[str, Any]) -> None:
        """A text replaces the one block that it nearly equals, if it may; it comes after all blocks if it is about none of them and is new."""
        if not text["key"] or text["box"] is None:
            return
        about = [b for b in self.blocks if b["key"] and b["box"] is not None and shared_area(text["box"], b["box"]) >= ABOUT]
        near = [b for b in about if T.keys_nearly_equal(text["key"], b["key"])]
        if len(near) == 1 and replaces(text, near[0]):
            old = near[0]
            sure = old["confidence"] if text["confidence"] is None else text["confidence"]
            old.update({c: text[c] for c in ("text", "canonical", "key", "box")}, confidence=sure, origin="replaced", original_text=old["text"])
            self.know(text)
        elif not near and not (about and T.keys_nearly_equal(text["key"], "".join(b["key"] for b in about))) and not text["whole_page"] and not self.says(text):
            self.blocks.append(text | {"line_no": -text["ordinal"] - 1, "origin": "appended", "original_text": None})
            self.know(text)


def _folded(batches: Iterator) -> Iterator:
    import pyarrow as pa

    kind = None
    for batch in batches:
        rows: list[dict[str, Any]] = []
        for p in batch.to_pylist():
            page = Page(p["blocks"] or [], p["page"])
            for text in p["texts"]:
                page.merge(text)
            rows += [{"doc_id": p["doc_id"], "page_index": p["page_index"], **{c: b[c] for c in ("line_no", "text", "box", "confidence", "origin", "original_text")}} for b in page.blocks]
        if kind is None:
            box = pa.struct([(n, pa.int32()) for n in "xywh"])
            kind = pa.schema([("doc_id", pa.int64()), ("page_index", pa.int32()), ("line_no", pa.int32()), ("text", pa.string()), ("box", box), ("confidence", pa.float64()), ("origin", pa.string()), ("original_text", pa.string())])
        yield pa.RecordBatch.from_pylist(rows, schema=kind)


def merge_artifact_text(blocks: DataFrame, candidates: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """(doc_id, page_index, line_no, text, box, confidence, origin, original_text): pages with recognised texts merged in.

    ``blocks``: keys, line_no, text, box, confidence and, if there is one, block_type; ``candidates``: keys, ordinal, text, box,
    confidence and, if there is one, whole_page, which tells texts of the whole page's recognition: these replace but are never appended.
    A page's text (``pages``: keys, text; where there is none, its blocks' texts as lines) is among what was said, so a text that spans blocks is not new.
    Blocks appended have negative numbers. Pages without recognised texts pass by the fold.
    """
    has = lambda df, name, default: F.col(name) if name in df.columns else default

    def entry(number: str, shown: Column, *more: Column) -> Column:
        said = [shown.alias("text"), F.col("_own.text").alias("canonical"), F.col("_own.said.key").alias("key"), F.col("_own.said.units").alias("units")]
        box = F.col("box").cast(_BOX).alias("box")
        return F.array_sort(F.collect_list(F.struct(F.col(number).cast("int").alias(number), *said, box, F.col("confidence").cast("double").alias("confidence"), *more)))

    kind = has(blocks, "block_type", F.lit(None).cast("string")).alias("kind")
    of_page = F.coalesce(has(candidates, "whole_page", F.lit(False)), F.lit(False)).alias("whole_page")
    keyed = lambda rows: rows.withColumn("_own", T.let(T.canonical(F.col("text")), lambda t: F.struct(t.alias("text"), T.key_and_units(t).alias("said"))))
    texts = keyed(candidates).groupBy(*PAGE).agg(entry("ordinal", T.strip(F.coalesce("text", F.lit(""))), F.lit(None).cast("string").alias("kind"), of_page).alias("texts"))
    own = keyed(blocks.join(candidates.select(*PAGE).distinct(), [*PAGE], "left_semi")).groupBy(*PAGE).agg(entry("line_no", F.col("text"), kind).alias("blocks"))
    both = texts.join(own, [*PAGE], "left")
    whole = F.array_join(F.transform("blocks", lambda b: b["text"]), "\n")
    if pages is not None:
        both = both.join(pages.select(*PAGE, F.col("text").alias("_page")), [*PAGE], "left")
        whole = F.coalesce("_page", whole)
    both = both.withColumn("_page", whole)
    page = F.when(T.strip(F.col("_page")) != "", F.struct(T.canonical_key(F.col("_page")).alias("key"), T.similarity_units(F.col("_page")).alias("units")))
    folded = both.select("doc_id", "page_index", "blocks", "texts", page.alias("page")).mapInArrow(_folded, MERGED)
    none = F.lit(None).cast("string").alias("original_text")
    others = blocks.join(candidates.select(*PAGE).distinct(), [*PAGE], "left_anti")
    return folded.unionByName(others.select(*PAGE, F.col("line_no").cast("int").alias("line_no"), "text", F.col("box").cast(_BOX).alias("box"), F.col("confidence").cast("double").alias("confidence"), F.lit("kept").alias("origin"), none))
