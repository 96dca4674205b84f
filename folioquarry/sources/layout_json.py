"""Readers of layout JSON: nested pages, flat block lists, table recogniser results, OCR arrays.

Open JSON is parsed once to VARIANT and read by path; numbers that are not numbers become null, as do
boxes that are not boxes. Positions of exploded arrays are kept as ordinals, so order never depends on
how rows are dealt. What lies at any depth (S7, S11) is walked in Arrow batches. Everything is a projection: no reader shuffles except to group blocks by page.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions import geometry as G
from ..functions import text as T
from ..functions import values as V

NUMBERS, TEXTS, ITEMS = "array<double>", "array<string>", "array<variant>"


def get(value: Column, path: str, kind: str = "string") -> Column:
    """A path of a VARIANT as a type, null where it is missing or of another kind."""
    return F.try_variant_get(value, f"$.{path}", kind)


def parsed(df: DataFrame, column: str = "json") -> DataFrame:
    """``df`` with the JSON text as VARIANT; null if it is no JSON."""
    return df.withColumn(column, F.try_parse_json(column))


def unwrap(value: Column) -> Column:
    """The payload within an envelope named res or output."""
    return F.coalesce(get(value, "res", "variant"), get(value, "output", "variant"), value)


def as_texts(value: Column, path: str) -> Column:
    """A text or a list of texts as a list without blanks."""
    many = get(value, path, TEXTS)
    one = F.when(get(value, path).isNotNull(), F.array(get(value, path)))
    return F.filter(F.transform(F.coalesce(many, one), T.strip), lambda x: x != "")


def must_be_list(value: Column, code: str) -> Column:
    """The array of a JSON list; anything else raises an error with the code."""
    items = F.try_variant_get(value, "$", ITEMS)
    return F.coalesce(items, F.raise_error(F.lit(code)).cast(ITEMS))


def children_box(block: Column) -> Column:
    """The box around the lines and spans of a block that has none of its own."""
    lines = get(block, "lines", ITEMS)
    own = F.transform(lines, lambda x: get(x, "bbox", NUMBERS))
    spans = F.flatten(F.transform(lines, lambda x: F.coalesce(F.transform(get(x, "spans", ITEMS), lambda s: get(s, "bbox", NUMBERS)), F.array().cast("array<array<double>>"))))
    inner = F.transform(get(block, "blocks", ITEMS), lambda x: get(x, "bbox", NUMBERS))
    empty = F.array().cast("array<array<double>>")
    every = F.filter(F.concat(F.coalesce(own, empty), F.coalesce(spans, empty), F.coalesce(inner, empty)), lambda b: F.size(b) >= 4)
    at = lambda i: F.transform(every, lambda b: b[i])
    return F.when(F.size(every) > 0, F.array(F.array_min(at(0)), F.array_min(at(1)), F.array_max(at(2)), F.array_max(at(3))))


# Where texts lie below a block, in order.
CHILDREN = ("blocks", "lines", "spans", "image_caption", "image_footnote", "table_caption", "table_footnote")


def fragments(payload) -> list[str]:
    """The texts below a parsed JSON value, in order and however deep."""
    out, stack = [], [payload]
    while stack:
        x = stack.pop()
        if isinstance(x, list):
            stack.extend(reversed(x))
        elif isinstance(x, dict):
            own = next((x[k] for k in ("content", "text") if isinstance(x.get(k), str)), "").strip()
            if own:
                out.append(own)
            stack.extend(x[k] for k in reversed(CHILDREN) if x.get(k) is not None)
    return out


def first_html(payload) -> str | None:
    """The first html below a parsed JSON value, a mapping's own before that of any of its values, in order and however deep."""
    stack = [payload]
    while stack:
        x = stack.pop()
        if isinstance(x, list):
            stack.extend(reversed(x))
        elif isinstance(x, dict):
            own = "" if x.get("html") is None else str(x["html"]).strip()
            if own:
                return own
            stack.extend(reversed(x.values()))
    return None


_BELOW = StructType([StructField("texts", ArrayType(StringType())), *[StructField(n, StringType()) for n in ("html", "caption", "footnote")]])


@F.arrow_udf(ArrayType(ArrayType(_BELOW)))
def below_blocks(texts: pa.Array) -> pa.Array:
    """S7, S11 of the blocks of each page of nested layout JSON; null if it is no JSON."""
    clean = lambda t: None if t is None else t.encode("utf-8", "replace").decode()

    def pages(text: str | None):
        try:
            value = None if text is None else json.loads(text)
        except ValueError:
            return None
        found = value.get("pdf_info") if isinstance(value, dict) else None
        out = []
        for page in found if isinstance(found, list) else []:
            kinds = [page.get(k) for k in ("para_blocks", "preproc_blocks")] if isinstance(page, dict) else []
            blocks = next((b for b in kinds if isinstance(b, list)), [])
            out.append([of_block(b) for b in blocks])
        return out

    def of_block(b) -> dict:
        part = lambda key: clean("\n".join(fragments(b.get(key) if isinstance(b, dict) else None)))
        return {"texts": [clean(t) for t in fragments(b)], "html": clean(first_html(b)), "caption": part("table_caption"), "footnote": part("table_footnote")}

    kind = pa.list_(pa.list_(pa.struct([("texts", pa.list_(pa.string())), *[(n, pa.string()) for n in ("html", "caption", "footnote")]])))
    return pa.array([pages(t) for t in texts.to_pylist()], kind)


def nested_pages(df: DataFrame, column: str = "json") -> DataFrame:
    """(source columns..., position, page_index, width, height, blocks, below) of nested layout JSON; para_blocks before preproc_blocks.

    ``below`` has the texts and the first html of each block. The column may be text or VARIANT; a VARIANT does not
    keep the order of keys, so html is first by the names of keys there.
    """
    keep = [c for c in df.columns if c != column]
    is_text = df.schema[column].dataType.typeName() == "string"
    value, text = (F.try_parse_json(column), F.col(column)) if is_text else (F.col(column), F.to_json(column))
    pages = must_be_list(get(value, "pdf_info", "variant"), "INVALID_LAYOUT_JSON")
    # each page takes what is below its own blocks, not what is below those of all pages
    both = df.select(*keep, pages.alias("pages"), below_blocks(text).alias("all")).withColumn("x", _paired("pages", "page", "all", "below"))
    # of an inner explode Spark infers a filter, which would parse the JSON once more
    rows = both.select(*keep, F.posexplode_outer("x").alias("position", "x")).where("position is not null").select(*keep, "position", "x.page", "x.below")
    size = get(F.col("page"), "page_size", NUMBERS)
    return rows.select(
        *keep, "position", V.page_index(get(F.col("page"), "page_idx", "int"), F.col("position")).alias("page_index"),
        F.try_element_at(size, F.lit(1)).alias("width"), F.try_element_at(size, F.lit(2)).alias("height"),
        F.coalesce(get(F.col("page"), "para_blocks", ITEMS), get(F.col("page"), "preproc_blocks", ITEMS), F.array().cast(ITEMS)).alias("blocks"),
        "below",
    )


def _paired(items: str, item: str, others: str, other: str) -> Column:
    """The entries of an array with those of another at the same places; null where it is shorter."""
    return F.transform(items, lambda x, i: F.struct(x.alias(item), F.get(others, i).alias(other)))


def page_text_blocks(pages: DataFrame) -> DataFrame:
    """The pages' blocks that have text and a box, one row each."""
    keep = [c for c in pages.columns if c not in ("blocks", "below")]
    rows = pages.select(*keep, F.posexplode(_paired("blocks", "b", "below", "own")).alias("ordinal", "x"))
    b = F.col("x.b")
    place = G.from_corners(F.coalesce(get(b, "bbox", NUMBERS), children_box(b)))
    words = F.array_join("x.own.texts", "\n")
    return rows.select(
        *keep, "ordinal", words.alias("text"), place.alias("bounding_box"), V.text_or(get(b, "type")).alias("block_type"), V.confidence(get(b, "score", "double")).alias("confidence"),
    ).where((F.col("text") != "") & F.col("bounding_box").isNotNull())


def page_tables(pages: DataFrame) -> DataFrame:
    """The pages' blocks of type table, with box, html, caption and footnote; numbered among all blocks of their page."""
    keep = [c for c in pages.columns if c not in ("blocks", "below")]
    rows = pages.select(*keep, F.posexplode(F.arrays_zip("blocks", "below")).alias("table_index", "x"))
    b = F.col("x.blocks")
    place = F.coalesce(G.from_corners(get(b, "bbox", NUMBERS)), G.from_corners(children_box(b)))
    return rows.where(get(b, "type") == "table").select(
        *keep, "table_index", F.format_string("p%d-mineru-t%d", "page_index", "table_index").alias("table_id"), place.alias("bounding_box"),
        F.col("x.below.html").alias("html"), F.col("x.below.caption").alias("caption"), F.col("x.below.footnote").alias("footnote"),
        V.confidence(get(b, "score", "double")).alias("confidence"), V.as_int(get(b, "index")).alias("raw_index"),
    ).where("bounding_box is not null")


def flat_blocks(df: DataFrame, column: str = "json", base: str | None = None) -> DataFrame:
    """One row per entry of a flat block list that has text and a box; an entry without a page gets its position."""
    keep = [c for c in df.columns if c != column]
    rows = df.select(*keep, F.posexplode(must_be_list(F.col(column), "INVALID_CONTENT_LIST")).alias("ordinal", "b"))
    b = F.col("b")
    return rows.select(
        *keep, "ordinal", V.page_index(get(b, "page_idx", "int"), F.col("ordinal")).alias("page_index"), V.text_or(get(b, "text")).alias("text"),
        G.from_corners(get(b, "bbox", NUMBERS)).alias("bounding_box"), V.text_or(get(b, "type")).alias("block_type"), V.confidence(get(b, "score", "double")).alias("confidence"),
        V.as_int(get(b, "text_level")).alias("text_level"), absolute(get(b, "img_path"), base).alias("image_uri"),
    ).where("text is not null and bounding_box is not null")


def flat_tables(df: DataFrame, column: str = "json", base: str | None = None) -> DataFrame:
    """The table entries of a flat block list, captions and footnotes joined."""
    keep = [c for c in df.columns if c != column]
    rows = df.select(*keep, F.posexplode(must_be_list(F.col(column), "INVALID_CONTENT_LIST")).alias("ordinal", "b")).where(get(F.col("b"), "type") == "table")
    b = F.col("b")
    lines = lambda path: F.nullif(F.array_join(as_texts(b, path), "\n"), F.lit(""))
    return rows.select(
        *keep, "ordinal", V.page_index(get(b, "page_idx", "int"), F.col("ordinal")).alias("page_index"), G.from_corners(get(b, "bbox", NUMBERS)).alias("bounding_box"),
        absolute(get(b, "img_path"), base).alias("image_uri"), F.coalesce(V.text_or(get(b, "table_body")), V.text_or(get(b, "html"))).alias("html"),
        lines("table_caption").alias("caption"), lines("table_footnote").alias("footnote"),
    ).where("bounding_box is not null")


def absolute(path: Column, base: str | None) -> Column:
    """Q5: a relative path below ``base``."""
    trimmed = V.text_or(path)
    return trimmed if base is None else F.when(trimmed.startswith("/"), trimmed).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), trimmed))


def by_page(blocks: DataFrame, *keys: str) -> DataFrame:
    """A4: blocks grouped by page in their order; a page's blocks are one row, as a page is."""
    body = [c for c in blocks.columns if c not in {*keys, "page_index", "ordinal"}]
    entry = F.struct("ordinal", *body)
    return blocks.groupBy(*keys, "page_index").agg(F.array_sort(F.collect_list(entry), lambda a, b: a["ordinal"] - b["ordinal"]).alias("blocks"))


def recogniser_tables(df: DataFrame, column: str = "json") -> DataFrame:
    """One row per table of a recogniser's pages: keys, page_index, table_index, width, height, table (VARIANT)."""
    keep = [c for c in df.columns if c != column]
    pages = df.select(*keep, F.posexplode(must_be_list(F.col(column), "INVALID_TABLE_PAGES")).alias("position", "raw")).withColumn("page", unwrap(F.col("raw")))
    rows = pages.select(
        *keep, V.page_index(get(F.col("page"), "page_index", "int"), F.col("position")).alias("page_index"), get(F.col("page"), "width", "double").alias("width"),
        get(F.col("page"), "height", "double").alias("height"), F.posexplode(get(F.col("page"), "table_res_list", ITEMS)).alias("table_index", "table"),
    )
    return rows


def recogniser_cells(tables: DataFrame, target_width: Column | None = None, target_height: Column | None = None) -> DataFrame:
    """One row per cell of a table's parallel arrays of boxes, texts and scores, which may differ in length.

    Cell boxes are used where there is one for each text, else the boxes of the texts, else the cell boxes.
    """
    keep = [c for c in tables.columns if c not in ("table",)]
    t = F.col("table")
    texts = F.transform(F.coalesce(get(t, "table_ocr_pred.rec_texts", TEXTS), F.array().cast(TEXTS)), T.strip)
    boxes = F.coalesce(get(t, "cell_box_list", "array<array<double>>"), F.array().cast("array<array<double>>"))
    of_texts = F.coalesce(get(t, "table_ocr_pred.rec_boxes", "array<array<double>>"), F.array().cast("array<array<double>>"))
    by_cell = (F.size(boxes) > 0) & (F.size(boxes) == F.size(texts))
    used = F.when(by_cell, boxes).when(F.size(of_texts) > 0, of_texts).otherwise(boxes)
    source = F.when(~by_cell & (F.size(of_texts) > 0), F.lit("table_ocr_pred.rec_boxes")).otherwise(F.lit("cell_box_list"))
    zipped = F.arrays_zip(used.alias("corners"), texts.alias("text"), get(t, "table_ocr_pred.rec_scores", NUMBERS).alias("score"))
    sized = tables.select(*keep, source.alias("bbox_source"), F.size(used).alias("n_boxes"), F.size(texts).alias("n_texts"), F.posexplode(zipped).alias("cell_index", "c"))
    fx = G.scale_factor(target_width, F.col("width")) if target_width is not None else F.lit(1.0)
    fy = G.scale_factor(target_height, F.col("height")) if target_height is not None else F.lit(1.0)
    return sized.where(F.col("cell_index") < F.greatest("n_boxes", "n_texts")).select(
        *keep, "cell_index", F.format_string("p%d-t%d-c%d", "page_index", "table_index", "cell_index").alias("cell_id"), F.coalesce("c.text", F.lit("")).alias("text"),
        G.from_any(F.col("c.corners"), scale_x=fx, scale_y=fy).alias("box"), V.confidence(F.col("c.score")).alias("confidence"), "bbox_source",
    ).where("box is not null or text <> ''")


def structure_cells(df: DataFrame, column: str = "json") -> DataFrame:
    """The cells of a table-structure result, moved and scaled from the crop into the page, with confidence and html; their texts are empty.

    Keys must include page_index, table_index and ``box``, the table's in the page; with image_width and image_height, the crop's
    size, cells are scaled to the box. Texts come from ``spatial.fill_cells``.
    """
    keep = [c for c in df.columns if c != column]
    raw = unwrap(F.col(column))
    boxes = get(raw, "bbox", "array<array<double>>")
    boxes = F.when(F.size(boxes) > 0, boxes).otherwise(get(raw, "cell_box_list", "array<array<double>>"))
    html = F.coalesce(V.text_or(get(raw, "pred_html")), T.html_of(get(raw, "structure", TEXTS)))
    one = F.lit(1.0)
    sized = {"image_width", "image_height"} <= set(keep)
    scale = lambda side, size: F.when((F.col("image_width") > 0) & (F.col("image_height") > 0), F.col(f"box.{side}") / F.col(size)).otherwise(one) if sized else one
    sure = V.confidence(get(raw, "structure_score", "double"))
    rows = df.where("box is not null").select(*keep, html.alias("html"), sure.alias("confidence"), F.posexplode(boxes).alias("cell_index", "corners"))
    place = G.from_any(F.col("corners"), scale_x=scale("w", "image_width"), scale_y=scale("h", "image_height"), offset_x=F.col("box.x").cast("double"), offset_y=F.col("box.y").cast("double"))
    return rows.select(
        *[c for c in keep if c != "box"], "cell_index", F.format_string("p%d-t%d-c%d", "page_index", "table_index", "cell_index").alias("cell_id"), F.lit("").alias("text"), place.alias("cell_box"), "confidence", "html",
    ).where("cell_box is not null").withColumnRenamed("cell_box", "box")


def page_scale(page: Column, target_width: Column | None, target_height: Column | None) -> tuple[Column, Column]:
    """From a page's own size to a target's; 1 where either is unknown."""
    size = lambda name: F.coalesce(get(page, name, "double"), get(page, f"source_{name}", "double"))
    one = F.lit(1.0)
    return (
        G.scale_factor(target_width, size("width")) if target_width is not None else one,
        G.scale_factor(target_height, size("height")) if target_height is not None else one,
    )


def block_text(block: Column) -> Column:
    """T9 of a raw block."""
    return T.choose_text(*[get(block, name) for name in ("block_content", "pred_html", "html", "text", "rec_text")])


def text_candidates(df: DataFrame, column: str = "json", target_width: Column | None = None, target_height: Column | None = None) -> DataFrame:
    """The texts of a layout artifact: its pages' blocks, their whole-page recognition, and the results of table crops, as one list.

    (keys, page_index, origin, ordinal, text, bounding_box, block_type, confidence); blank texts and rows without a box are left out.
    """
    keep = [c for c in df.columns if c != column]
    raw = df.select(*keep, F.posexplode(get(F.col(column), "pages", ITEMS)).alias("position", "raw")).withColumn("page", unwrap(F.col("raw")))
    fx, fy = page_scale(F.col("page"), target_width, target_height)
    height = F.coalesce(get(F.col("page"), "height", "double"), get(F.col("page"), "source_height", "double"))
    pages = raw.select(*keep, V.page_index(get(F.col("page"), "page_index", "int"), F.col("position")).alias("page_index"), "page", fx.alias("fx"), fy.alias("fy"), height.alias("height"))
    b, o, r = F.col("b"), get(F.col("page"), "overall_ocr_res", "variant"), F.col("r")
    label = F.coalesce(V.text_or(get(b, "block_label")), F.lit("text"))
    blocks = pages.select(*keep, "page_index", "fx", "fy", F.posexplode(get(F.col("page"), "parsing_res_list", ITEMS)).alias("ordinal", "b")).select(
        *keep, "page_index", F.lit("parsing_res_list").alias("origin"), "ordinal", block_text(b).alias("text"),
        G.from_corners(F.coalesce(get(b, "block_bbox", NUMBERS), get(b, "bbox", NUMBERS)), F.col("fx"), F.col("fy"), order="swap").alias("bounding_box"),
        F.concat(F.lit("paddle_"), label).alias("block_type"), F.coalesce(get(b, "score", "double"), get(b, "confidence", "double")).alias("confidence"),
    )
    polygons = F.coalesce(get(o, "dt_polys", "array<array<array<double>>>"), get(o, "rec_polys", "array<array<array<double>>>"))
    around = F.transform(polygons, lambda p: F.array(*[f(F.transform(p, _axis(i))) for f in (F.array_min, F.array_max) for i in (0, 1)]))
    zipped = F.arrays_zip(get(o, "rec_texts", TEXTS).alias("text"), F.coalesce(get(o, "rec_boxes", "array<array<double>>"), around).alias("corners"), get(o, "rec_scores", NUMBERS).alias("score"))
    whole = pages.select(*keep, "page_index", "fx", "fy", "height", F.posexplode(zipped).alias("ordinal", "c")).select(
        *keep, "page_index", "ordinal", T.canonical(F.col("c.text")).alias("text"), G.from_corners(F.col("c.corners"), F.col("fx"), F.col("fy"), order="swap").alias("bounding_box"), F.col("c.score").alias("confidence"), "height",
    )
    numbered = F.col("text").rlike("^[0-9]{1,4}$") & G.page_margin(F.col("bounding_box"), F.col("height"))
    whole = whole.select(*keep, "page_index", F.lit("overall_ocr_res").alias("origin"), "ordinal", "text", "bounding_box", F.when(numbered, F.lit("page_number")).otherwise(F.lit("paddle_ocr_text")).alias("block_type"), "confidence")
    crops = df.select(*keep, F.posexplode(get(F.col(column), "raw_results", ITEMS)).alias("ordinal", "r")).select(
        *keep, V.as_int(get(r, "candidate.page_index")).alias("page_index"), F.lit("raw_results").alias("origin"), "ordinal", block_text(unwrap(get(r, "result", "variant"))).alias("text"),
        F.coalesce(G.from_corners(get(r, "candidate.bbox", NUMBERS), order="swap"), G.rounded(*[get(r, f"candidate.bbox.{n}", "double") for n in "xywh"])).alias("bounding_box"),
        F.lit("paddle_table").alias("block_type"), get(r, "result.structure_score", "double").alias("confidence"),
    )
    every = blocks.unionByName(whole).unionByName(crops)
    return every.where("page_index is not null and text <> '' and bounding_box is not null")


def _axis(i: int):
    return lambda q: q[i]


def ocr_lines(df: DataFrame, column: str = "json") -> DataFrame:
    """The lines of whole-page OCR arrays, one row each; blank texts and lines without a box are left out."""
    keep = [c for c in df.columns if c != column]
    pages = df.select(*keep, F.posexplode(must_be_list(F.col(column), "INVALID_OCR_PAGES")).alias("position", "raw")).withColumn("page", unwrap(F.col("raw")))
    o = F.coalesce(get(F.col("page"), "overall_ocr_res", "variant"), F.col("page"))
    # Polygons where there are no boxes
    polygons = F.transform(get(o, "rec_polys", "array<array<array<double>>>"), lambda p: F.array(
        F.array_min(F.transform(p, lambda q: q[0])), F.array_min(F.transform(p, lambda q: q[1])), F.array_max(F.transform(p, lambda q: q[0])), F.array_max(F.transform(p, lambda q: q[1]))))
    boxes = F.coalesce(get(o, "rec_boxes", "array<array<double>>"), polygons)
    zipped = F.arrays_zip(get(o, "rec_texts", TEXTS).alias("text"), boxes.alias("corners"), get(o, "rec_scores", NUMBERS).alias("score"))
    rows = pages.select(*keep, V.page_index(get(F.col("page"), "page_index", "int"), F.col("position")).alias("page_index"), F.posexplode(zipped).alias("ordinal", "c"))
    return rows.select(
        *keep, "page_index", "ordinal", T.squeeze(F.col("c.text")).alias("text"), G.from_corners(F.col("c.corners"), order="swap").alias("bounding_box"), F.col("c.score").alias("confidence"),
    ).where("text <> '' and bounding_box is not null")


def layout_regions(df: DataFrame, column: str = "json", labels: tuple[str, ...] | None = None) -> DataFrame:
    """The labelled regions of layout pages; of some labels only, if given."""
    keep = [c for c in df.columns if c != column]
    pages = df.select(*keep, F.posexplode(must_be_list(F.col(column), "INVALID_LAYOUT_PAGES")).alias("position", "raw")).withColumn("page", unwrap(F.col("raw")))
    regions = get(F.col("page"), "parsing_res_list", ITEMS)
    rows = pages.select(*keep, V.page_index(get(F.col("page"), "page_index", "int"), F.col("position")).alias("page_index"), F.posexplode(regions).alias("ordinal", "b"))
    b = F.col("b")
    label = F.lower(T.strip(F.coalesce(get(b, "block_label"), get(b, "label"), F.lit("text"))))
    found = rows.select(
        *keep, "page_index", "ordinal", label.alias("label"), G.from_corners(F.coalesce(get(b, "block_bbox", NUMBERS), get(b, "bbox", NUMBERS)), order="swap").alias("bounding_box"),
        block_text(b).alias("text"),
        F.coalesce(get(b, "score", "double"), get(b, "confidence", "double")).alias("confidence"),
    ).where("bounding_box is not null")
    return found.where(F.col("label").isin(*labels)) if labels else found
