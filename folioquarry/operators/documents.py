"""Documents from paths, their options, and their results in the shape that leaves the library."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from ..functions import values as V
from ..functions.jsontree import map_strings
from .base import Context, OperatorError
from .spatial import PAGE

# What documents from bare paths are owned by, and the defaults of the options of a run.
OWNER = "mineru"
DEFAULT_OPTIONS = {"parse_method": "auto", "backend": "pipeline", "lang": "ch", "timeout_seconds": "1800"}
TABLE_OPTIONS = {
    "paddle": {"enable_table_cell_refine": "true", "enable_paddle_table_refine": "true", "table_cell_refine_fail_open": "false", "emit_table_cells_as_text_blocks": "false", "paddle_table_mode": "auto", "paddle_vl_version": "1.6"},
    "ocr": {"enable_table_cell_refine": "false", "enable_paddle_table_refine": "false"},
}
# Where the concurrency that a caller wants is looked for, in order.
CONCURRENCY_OPTIONS = ("caller_concurrency", "max_concurrency", "concurrency")
# Fixed value: how far beyond a page's size its content may reach before the size is not believed.
BEYOND = 1.05


def options_of(given: Column, engine: str = "ocr", context: Context = Context(), **more: str) -> Column:
    """The options of a document (map of texts): what it brings, then those of the call, of its table engine and the defaults; the first to name an option decides."""
    if engine not in TABLE_OPTIONS:
        raise ValueError(f"table engine must be one of {sorted(TABLE_OPTIONS)}")
    version = {"config_version": context.config_version} if context.config_version else {}
    later = DEFAULT_OPTIONS | TABLE_OPTIONS[engine] | version | more
    own = F.coalesce(given, F.create_map().cast("map<string,string>"))
    rest = F.create_map(*[F.lit(x) for kv in later.items() for x in kv])
    return T.let(own, lambda m: F.map_concat(F.map_filter(rest, lambda k, v: ~F.map_contains_key(m, k)), m))


def positive(value: Any, name: str) -> float:
    """A number above 0, else an error that names the option."""
    try:
        number = float(value) if not isinstance(value, bool) else 0.0
    except (TypeError, ValueError):
        number = 0.0
    if not number > 0:
        raise OperatorError(f"{name} must be a positive number", code="INVALID_OPERATOR_OPTION", details={"option": name, "value": value})
    return number


def positive_or_null(value: Column) -> Column:
    """N5 as a column."""
    number = V.as_double(value)
    return F.when(number > 0, number)


def safety(options: Column, recommended: int | None = None, max_inflight: int | None = None) -> Column:
    """What is reported of a document's limits: time, slots, and whether more concurrency is asked for than is recommended."""
    asked = F.coalesce(*[F.when(V.as_int(options[name]) > 0, V.as_int(options[name])) for name in CONCURRENCY_OPTIONS])
    return F.struct(
        positive_or_null(options["timeout_seconds"]).alias("timeout_seconds"), F.lit(max_inflight).cast("int").alias("max_inflight"), F.lit(recommended).cast("int").alias("recommended_max_concurrency"),
        asked.alias("requested_concurrency"), (asked > F.lit(recommended).cast("int")).alias("exceeds_recommendation"),
    )


def documents_of(paths: DataFrame, column: str = "path") -> DataFrame:
    """Documents from bare paths: an id of their stem, their type, and the owner that such documents have."""
    p = F.col(column)
    owner = [F.lit(OWNER).alias(n) for n in ("archive_id", "archive_owner_user_id", "triggered_by_user_id")]
    return paths.select(*owner, T.safe_id(p).alias("doc_id"), p.alias("file_uri"), T.media_type(p).alias("mime_type"))


def record_path(options: Column, doc_id: Column, context: Context, folder: str | None = None) -> Column:
    """K7: where the record of a failure goes: the document's output folder, else its or the operator's record folder, else the workspace's logs."""
    name = F.concat(T.safe_ascii(doc_id), F.lit("-"), T.safe_ascii(F.lit(context.trace_id)), F.lit("-operate_error.json"))
    own, records = V.text_or(options["output_dir"]), V.text_or(options["failure_record_dir"])
    return F.when(own.isNotNull(), F.concat(own, F.lit("/operate_error.json"))).otherwise(F.concat(F.coalesce(records, F.lit(folder), F.lit("logs/operator_failures")), F.lit("/"), name))


def page_sizes(pages: DataFrame, extents: DataFrame) -> DataFrame:
    """(doc_id, page_index, width, height): sizes of pages, null where the page's content reaches beyond them. ``extents`` as ``tables.extents``."""
    joined = pages.select(*PAGE, "width", "height").alias("p").join(extents.select(*PAGE, F.col("width").alias("reach_x"), F.col("height").alias("reach_y")), [*PAGE], "left")
    known = (F.col("width") > 0) & (F.col("height") > 0)
    wrong = known & ((F.col("reach_x") > F.col("width") * BEYOND) | (F.col("reach_y") > F.col("height") * BEYOND))
    kept = lambda n: F.when(~F.coalesce(wrong, F.lit(False)), F.col(n)).alias(n)
    return joined.select(*PAGE, kept("width"), kept("height"))


def crop_box(box: Column, width: Column, height: Column) -> Column:
    """The part of a box that lies in a picture; null if there is none."""
    x0, y0 = F.greatest(F.lit(0), box["x"]), F.greatest(F.lit(0), box["y"])
    x1, y1 = F.least(width, box["x"] + box["w"]), F.least(height, box["y"] + box["h"])
    return F.when((x1 > x0) & (y1 > y0), G.box(x0, y0, x1 - x0, y1 - y0))


def run_ids(df: DataFrame, context: Context = Context()) -> DataFrame:
    """``df`` with the ids of its run; ids that the context lacks are drawn once, for all rows alike."""
    return df.withColumns({"trace_id": F.lit(context.trace_id or str(uuid.uuid4())), "run_id": F.lit(context.run_id or str(uuid.uuid4()))})


def document_results(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per document: its name, pages in order, and the facts of the first; without what only the library needs.

    ``pages``: doc_id, page_index, text and whatever else a page holds; ``documents``: doc_id, file_uri.
    """
    body = [c for c in pages.columns if c not in ("doc_id", "page_index")]
    page = F.struct("page_index", *body)
    own = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(page), lambda a, b: a["page_index"] - b["page_index"]).alias("pages"))
    joined = documents.select("doc_id", F.col("file_uri").alias("source_pdf")).join(own, "doc_id")
    return joined.select("doc_id", "source_pdf", F.element_at(F.split("source_pdf", "/"), -1).alias("source_file_name"), F.size("pages").alias("page_count"), "pages")


def run_results(pages: DataFrame, documents: DataFrame, artifacts: DataFrame | None = None, context: Context = Context()) -> DataFrame:
    """The results of single-document runs, a row per document: ids of the run, pages, and what the first page tells of all.

    ``pages``: doc_id, page_index and whatever a page holds; of these the first page's coord_space, layout_provider and image (width, height), if there are such columns, are the
    document's. ``artifacts``: doc_id, kind, uri, one of each; a document without pages has none of its own facts. With table refinement the options are those of
    ``options_of(engine="paddle")``; the shape is the same.
    """
    first = lambda c: F.min_by(c, "page_index").alias(c)
    known = [c for c in ("coord_space", "layout_provider", "width", "height") if c in pages.columns]
    held = F.struct("page_index", *[c for c in pages.columns if c not in ("doc_id", "page_index")])
    own = pages.groupBy("doc_id").agg(
        F.count("*").alias("page_count"), *[first(c) for c in known], F.array_sort(F.collect_list(held), lambda a, b: a["page_index"] - b["page_index"]).alias("pages"),
    )
    out = run_ids(documents.select("doc_id", F.col("file_uri").alias("pdf_path")), context).join(own, "doc_id", "left").withColumn("page_count", F.coalesce("page_count", F.lit(0)))
    if "coord_space" in known:
        out = out.withColumn("coord_space", F.coalesce("coord_space", F.lit("mineru_layout")))
    none = F.array().cast("array<struct<kind: string, uri: string>>")
    if artifacts is None:
        return out.withColumn("artifacts", none)
    listed = artifacts.select("doc_id", "kind", "uri").distinct().groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("kind", "uri"))).alias("artifacts"))
    return out.join(listed, "doc_id", "left").withColumn("artifacts", F.coalesce("artifacts", none))


def relocated(value: Column, relocations: list[tuple[str, str]]) -> Column:
    """Open JSON (VARIANT) in which every string that is an old folder, or a path below it, names the new one; the first folder that fits decides.

    Keys, and strings that only mention a path, stay.
    """

    def moved(path: Column) -> Column:
        out = path
        for old, new in reversed(relocations):
            old, new = old.rstrip("/"), new.rstrip("/")
            out = F.when((path == old) | path.startswith(old + "/"), F.concat(F.lit(new), F.substring(path, F.lit(len(old) + 1), F.char_length(path)))).otherwise(out)
        return out

    return map_strings(value, moved)


def keyword_list(text: Column) -> Column:
    """Keywords given as a JSON list or text, or as plain text; trimmed, without blanks."""
    many = F.try_variant_get(F.try_parse_json(text), "$", "array<string>")
    one = F.try_variant_get(F.try_parse_json(text), "$", "string")
    listed = F.when(text.rlike(r"^\s*\["), many)
    split = F.flatten(F.transform(F.coalesce(listed, F.array(F.when(text.rlike(r'^\s*"'), one).otherwise(text))), lambda t: T.split_keywords(F.coalesce(t, F.lit("")))))
    return F.coalesce(split, F.array().cast("array<string>"))


def with_image(candidates: DataFrame) -> DataFrame:
    """table candidates that have a picture to read."""
    return candidates.where(V.text_or(F.col("image_uri")).isNotNull())


def whole_page(origin: Column) -> Column:
    """whether a text comes from the recognition of a whole page."""
    return F.coalesce(origin == "overall_ocr_res", F.lit(False))


def without_html(meta: Column) -> Column:
    """The facts of a table candidate but its html."""
    return F.map_filter(meta, lambda k, v: k != "html")


def phrase_boxes(blocks: DataFrame, phrases: DataFrame) -> DataFrame:
    """The boxes of a page's blocks that a range of the page's text lies in, clipped to the range's share of each.

    ``blocks``: doc_id, page_index, line_no, text, box; a page's text is its blocks' joined by line feeds. ``phrases``: doc_id,
    page_index, char_start, char_end (exclusive) and whatever else. A block's characters are taken to be equally wide.
    """
    page = blocks.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("line_no", F.char_length("text").alias("n"), "box"))).alias("b"))

    def placed(acc: Column, b: Column) -> Column:
        at = F.struct(acc["at"].alias("at"), b["n"].alias("n"), b["line_no"].alias("line_no"), b["box"].alias("box"))
        return F.struct((acc["at"] + b["n"] + 1).alias("at"), F.array_append(acc["out"], at).alias("out"))

    kind = blocks.schema["box"].dataType.simpleString()
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<at: int, n: int, line_no: int, box: {kind}>>").alias("out"))
    laid = page.select(*PAGE, F.aggregate("b", start, placed, lambda acc: acc["out"]).alias("laid"))
    joined = phrases.join(laid, [*PAGE])
    met = F.filter("laid", lambda b: (b["at"] < F.col("char_end")) & (b["at"] + b["n"] > F.col("char_start")))
    rows = joined.select(*phrases.columns, F.explode(met).alias("m"))
    first, last = F.greatest(F.lit(0), F.col("char_start") - F.col("m.at")), F.least(F.col("m.n"), F.col("char_end") - F.col("m.at"))
    per = F.col("m.box.w") / F.col("m.n")
    x, w = F.col("m.box.x") + F.floor(per * first), F.ceil(per * (last - first))
    return rows.select(*phrases.columns, F.col("m.line_no").alias("line_no"), G.box(x.cast("int"), F.col("m.box.y"), w.cast("int"), F.col("m.box.h")).alias("box"))


def trials_in_order(trials: DataFrame, *keys: str) -> DataFrame:
    """Trials by their composite key, nulls first."""
    return trials.orderBy(*[F.col(k).asc_nulls_first() for k in keys])


def in_input_order(results: DataFrame, inputs: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Results with the ordinal of their input, in its order, however they were worked."""
    return results.join(inputs.select(key, ordinal), key).orderBy(ordinal)


def markdown_targets(markdown: DataFrame, artifacts: DataFrame, folders: DataFrame) -> DataFrame:
    """(doc_id, path, text, added): where each document's Markdown goes: its Markdown artifacts, or a new file in its folder; blank texts go nowhere.

    ``markdown``: doc_id, markdown; ``artifacts``: doc_id, kind, uri; ``folders``: doc_id, artifact_dir, output_stem.
    """
    texts = markdown.where(T.strip(F.coalesce("markdown", F.lit(""))) != "").select("doc_id", F.col("markdown").alias("text"))
    had = artifacts.where((F.col("kind") == "markdown") & V.text_or(F.col("uri")).isNotNull()).select("doc_id", F.col("uri").alias("path")).distinct()
    kept = texts.join(had, "doc_id").select("doc_id", "path", "text", F.lit(False).alias("added"))
    new = texts.join(had, "doc_id", "left_anti").join(folders, "doc_id")
    return kept.unionByName(new.select("doc_id", F.concat(F.regexp_replace("artifact_dir", "/+$", ""), F.lit("/"), "output_stem", F.lit(".md")).alias("path"), "text", F.lit(True).alias("added")))


def text_of_page(block_texts: Column, fragments: Column) -> Column:
    """Q6: a page's text from its blocks' texts, or from whatever texts lie below it where no block has one; null if there is none."""
    joined = lambda a: F.nullif(F.array_join(F.filter(F.coalesce(a, F.array().cast("array<string>")), lambda t: T.strip(t) != ""), "\n"), F.lit(""))
    return F.coalesce(joined(block_texts), joined(fragments))
