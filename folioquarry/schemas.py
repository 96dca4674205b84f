"""Row types of the document-layout model, and their checks as column expressions.

Fields whose content is open (``meta``, ``options``, ...) are VARIANT: readable by path without a
schema, and never parsed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOX = "struct<x: int, y: int, w: int, h: int>"
QUAD = "struct<x0: double, y0: double, x1: double, y1: double>"
TEXT_BLOCK = f"struct<text: string, bounding_box: {BOX}, block_type: string, confidence: double, meta: variant>"
TABLE_CELL = f"struct<cell_id: string, text: string, bounding_box: {BOX}, row_index: int, col_index: int, row_span: int, col_span: int, confidence: double, meta: variant>"
TABLE_BLOCK = f"struct<table_id: string, page_index: int, provider: string, bounding_box: {BOX}, coord_space: string, html: string, cells: array<{TABLE_CELL}>, confidence: double, meta: variant>"
IMAGE_SIZE = "struct<width: int, height: int, dpi: struct<height: double, width: double>>"
ARTIFACT = "struct<kind: string, uri: string, `inline`: variant, checksum: string, meta: variant>"
PROVENANCE = f"struct<source: string, page_index: int, char_start: int, char_end: int, span_id: string, bbox: {QUAD}, quote: string>"
OWNER = "archive_id string, archive_owner_user_id string, triggered_by_user_id string, doc_id string"
JOBS = "archive_id string, job_id string, triggered_by_user_id string, triggered_at timestamp, source_paths array<string>, options variant, config_version string"
DOCUMENTS = f"{OWNER}, file_uri string, mime_type string, file_hash string, num_pages int, meta variant, artifact_ref {ARTIFACT}"
PAGES = f"{OWNER}, page_index int, text string, text_artifact_ref {ARTIFACT}, text_blocks array<{TEXT_BLOCK}>, table_blocks array<{TABLE_BLOCK}>, page_meta variant, image_ref {ARTIFACT}, layout_ref {ARTIFACT}"
SPANS = f"{OWNER}, page_index int, span_id string, text string, risk_type string, score double, bbox {QUAD}, coord_space string, evidence variant, provenance {PROVENANCE}, span_type string, detection_actor string, detected_by_user_id string, detected_at timestamp"

# The spaces in which coordinates are given.
COORD_SPACES = ("mineru_layout", "pdf_points", "image_pixels", "normalized_0_1")


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def implies(a: Column, b: Column) -> Column:
    return ~F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False))


def one_payload(uri: Column, inline: Column) -> Column:
    """V1: either an address or an inline value, not both; an empty inline value counts."""
    return blank(uri) == inline.isNotNull()


def ordered(start: Column, end: Column) -> Column:
    """V2"""
    return F.coalesce(end >= start, F.lit(False))


def paths_given(paths: Column) -> Column:
    """V3: at least one path, none blank."""
    return F.coalesce((F.size(paths) > 0) & F.forall(paths, lambda p: ~blank(p)), F.lit(False))


def uri_valid(uri: Column, most: int = 8192) -> Column:
    """V4"""
    return F.coalesce(F.char_length(F.trim(uri)).between(1, most), F.lit(False))


def placed(bbox: Column, space: Column) -> Column:
    """V5: a box needs its coordinate space."""
    return bbox.isNull() | space.isNotNull()


def page_agrees(provenance: Column, page: Column) -> Column:
    """V6"""
    return provenance.isNull() | provenance.getField("page_index").eqNullSafe(page)


def actor_known(actor: Column, user: Column) -> Column:
    """V7: what a user found names the user."""
    return implies(actor == "user", ~blank(user))


def confirmed_whole(user: Column, at: Column) -> Column:
    """V8: who and when, or neither."""
    return blank(user) == at.isNull()


def spans_belong(spans: Column, *keys: str) -> Column:
    """V9: each embedded span carries its document's keys."""
    own = {k: F.col(k) for k in keys}

    def agree(s: Column) -> Column:
        out = F.lit(True)
        for k, v in own.items():
            out = out & s.getField(k).eqNullSafe(v)
        return out

    return F.coalesce(F.forall(spans, agree), F.lit(True))


def in_range(value: Column, least: float | None = None, most: float | None = None) -> Column:
    """Null, or a number within bounds; NaN is out of any."""
    ok = F.lit(True)
    if least is not None:
        ok = ok & (value >= least)
    if most is not None:
        ok = ok & (value <= most)
    return value.isNull() | (ok & ~F.isnan(value.cast("double")))


def violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``df`` with ``violations``: the names of the checks that a row fails, in order."""
    failed = [F.when(~ok, F.lit(name)) for name, ok in checks.items()]
    return df.withColumn("violations", F.array_compact(F.array(*failed)))


def enforce(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``df``; reading a row that fails a check raises an error that names it."""
    found = violations(df, checks)
    guard = F.when(F.size("violations") > 0, F.raise_error(F.concat(F.lit("violated: "), F.array_join("violations", ", "))))
    return found.where(guard.isNull()).drop("violations")


def conform(df: DataFrame, schema: str) -> DataFrame:
    """``df`` in a declared schema; an unknown column is an error, a missing one is null."""
    from pyspark.sql.types import StructType

    declared = StructType.fromDDL(schema)
    unknown = set(df.columns) - set(declared.names)
    if unknown:
        raise ValueError(f"columns that the schema lacks: {sorted(unknown)}")
    return df.to(declared)
