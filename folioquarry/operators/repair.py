"""Repairs of recognised tables and of the Markdown made from them: dates, fragments, flipped boxes, blank cells, seals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import markdown as M
from ..functions import text as T
from .reading import reading_order
from .refine import column_lines
from .spatial import PAGE, same_page

# A serial number that holds a day, headers of columns of days, and of columns of pictures.
SERIAL_DAY = r"[A-Za-z][0-9]?(20[0-9]{2})(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])[0-9]{4}(?![0-9])"
DAY_HEADERS, PICTURE_HEADERS = "(时间|日期)$", ("人像信息", "签字信息")
# A whole day, and what is left of one that was cut.
WHOLE_DAY, CUT_DAY = r"^[0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日$", r"^[0-9年月日]*$"
# Fixed value: how much higher than wide a fragment of vertical writing is.
UPRIGHT = 2


def serial_day(text: Column) -> Column:
    """The day in a serial number of the text, without leading zeros; null if there is none."""
    part = lambda k: F.regexp_extract(text, SERIAL_DAY, k)
    number = lambda k: part(k).cast("int").cast("string")
    return F.when(text.rlike(SERIAL_DAY), F.concat(part(1), F.lit("年"), number(2), F.lit("月"), number(3), F.lit("日")))


def is_cut_day(text: Column) -> Column:
    """Blank, or part of a day."""
    t = T.strip(F.coalesce(text, F.lit("")))
    return t.rlike(CUT_DAY) & ~t.rlike(WHOLE_DAY)


def repaired_days(cells: DataFrame, pages: DataFrame, *keys: str) -> DataFrame:
    """``cells`` (keys, row_index, col_index, text) whose column is headed as one of days and whose day is missing or cut, with the day of the page's serial number.

    ``pages``: doc_id, page_index, text. Headers are the cells of row 0; cells that are alike stay as many as they are.
    """
    headed = cells.where((F.col("row_index") == 0) & T.strip(F.col("text")).rlike(DAY_HEADERS)).select(*keys, "col_index").distinct().withColumn("_days", F.lit(True))
    days = pages.select(*PAGE, serial_day(F.col("text")).alias("_day")).where("_day is not null")
    joined = cells.join(headed, [*keys, "col_index"], "left").join(days, [*PAGE], "left")
    wrong = F.coalesce("_days", F.lit(False)) & (F.col("row_index") > 0) & is_cut_day(F.col("text")) & F.col("_day").isNotNull()
    return joined.select(*[F.when(wrong, F.col("_day")).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in cells.columns], wrong.alias("repaired"))


def repaired_pipes(markdown: Column) -> Column:
    """Pipe tables of a Markdown text whose cut days, in columns headed as such, are those of its serial number. Rows without such a day, and all other text, stay as they are."""

    def of_table(table: Column, day: Column) -> Column:
        def rows(lines: Column) -> Column:
            def one(line: Column, i: Column, head: Column) -> Column:
                cells = M.cells_of(line)
                dated = lambda c, j: F.when(F.coalesce(F.get(head, j).rlike(DAY_HEADERS), F.lit(False)) & is_cut_day(c), day).otherwise(c)
                fixed = T.let(cells, lambda cs: F.struct(cs.alias("old"), F.transform(cs, dated).alias("new")))
                end = F.when(line.endswith("\n"), F.lit("\n")).otherwise(F.lit(""))
                return F.when(i < 2, line).otherwise(T.let(fixed, lambda v: F.when(v["old"] == v["new"], line).otherwise(F.concat(M.row_of(v["new"]), end))))

            return T.let(M.cells_of(F.get(lines, F.lit(0))), lambda head: F.array_join(F.transform(lines, lambda x, i: one(x, i, head)), ""))

        return T.let(M.lines_of(table), rows)

    return T.let(
        F.struct(markdown.alias("text"), serial_day(markdown).alias("day")),
        lambda v: F.when(v["day"].isNull(), v["text"]).otherwise(M.edited(v["text"], pipe=lambda table: of_table(table, v["day"]))),
    )


def covering(first: DataFrame, second: DataFrame, html: DataFrame, *keys: str) -> DataFrame:
    """The cells of ``first``, or those of ``second`` for tables of whose html cells ``first`` has fewer than there are; ``fallback`` tells which."""
    wanted = html.select(*keys, F.size(T.cell_texts(F.col("html"))).alias("wanted"))
    had = first.groupBy(*keys).agg(F.count("*").alias("had"))
    poor = wanted.join(had, list(keys), "left").where(F.coalesce("had", F.lit(0)) < F.col("wanted")).select(*keys)
    poor = poor.join(second.select(*keys).distinct(), list(keys), "left_semi")
    kept = first.join(poor, list(keys), "left_anti").withColumn("fallback", F.lit(False))
    return kept.unionByName(second.join(poor, list(keys), "left_semi").withColumn("fallback", F.lit(True)))


def upright(fragments: DataFrame, *keys: str) -> DataFrame:
    """``fragments`` (keys, ordinal, text, box) whose table was read upside down with their boxes turned around within the area that they cover; ``flipped`` tells which.

    A table is upside down if, in the order of reading, boxes go up or left more often than down or right.
    """
    place = F.struct("ordinal", F.col("box.x").alias("x"), F.col("box.y").alias("y"), F.col("box.w").alias("w"), F.col("box.h").alias("h"))
    tables = fragments.groupBy(*keys).agg(F.array_sort(F.collect_list(place)).alias("f"))

    def back(a: Column, b: Column) -> Column:
        down, right = G.center_y(b) - G.center_y(a), G.center_x(b) - G.center_x(a)
        level = F.abs(down) <= F.least(a["h"], b["h"]) / 2
        ahead = F.when(level, right).otherwise(down)
        return F.when(ahead < 0, 1).when(ahead > 0, -1).otherwise(0)

    steps = F.zip_with(F.slice("f", 1, F.size("f") - 1), F.slice("f", 2, F.size("f") - 1), back)
    score = F.when(F.size("f") > 1, F.aggregate(steps, F.lit(0), lambda a, x: a + x)).otherwise(F.lit(0))
    low = lambda n: F.array_min(F.transform("f", lambda p: p[n]))
    high = lambda n, s: F.array_max(F.transform("f", lambda p: p[n] + p[s]))
    turned = tables.select(*keys, (score > 0).alias("flipped"), (low("x") + high("x", "w")).alias("sx"), (low("y") + high("y", "h")).alias("sy"))
    joined = fragments.join(turned, list(keys))
    around = G.box(F.col("sx") - F.col("box.x") - F.col("box.w"), F.col("sy") - F.col("box.y") - F.col("box.h"), F.col("box.w"), F.col("box.h"))
    return joined.select(*[F.when(F.col("flipped"), around).otherwise(F.col("box")).alias("box") if c == "box" else F.col(c) for c in fragments.columns], "flipped")


def written_in(fragments: Column) -> Column:
    """The text of a cell's fragments (array of struct<y, x, ordinal, text, w, h>): from top to bottom and left to right, without gaps.

    Fragments of vertical writing beside each other are read across, one character of each at a time, at the place of the highest.
    """
    tall = lambda f: (f["h"] >= f["w"] * UPRIGHT) & (F.char_length(f["text"]) > 1)
    columns = F.array_sort(F.transform(F.filter(fragments, tall), lambda f: F.struct(f["x"].alias("x"), f["text"].alias("text"), f["y"].alias("y"))))
    longest = F.array_max(F.transform(columns, lambda c: F.char_length(c["text"])))
    across = F.array_join(F.transform(F.sequence(F.lit(1), longest), lambda k: F.array_join(F.transform(columns, lambda c: F.substring(c["text"], k, F.lit(1))), "")), "")
    entry = lambda y, x, t: F.struct(y.cast("double").alias("y"), x.cast("double").alias("x"), t.alias("text"))
    one = F.when(F.size(columns) > 1, F.array(entry(F.array_min(F.transform(columns, lambda c: c["y"])), columns[0]["x"], across)))
    rows = F.when(F.size(columns) > 1, F.filter(fragments, lambda f: ~tall(f))).otherwise(fragments)
    every = F.concat(F.coalesce(one, F.array().cast("array<struct<y: double, x: double, text: string>>")), F.transform(rows, lambda f: entry(f["y"], f["x"], f["text"])))
    return F.array_join(F.transform(F.array_sort(every), lambda e: e["text"]), "")


def fragments_into_cells(cells: DataFrame, fragments: DataFrame, *keys: str) -> DataFrame:
    """``cells`` (keys, cell_no, box) with the text of the fragments (keys, ordinal, text, box) centred in them, and their number; a fragment goes to the first cell around it."""
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"f.{k}") == F.col(f"c.{k}"))
    hits = fragments.where(T.strip(F.col("text")) != "").alias("f").join(cells.alias("c"), on & G.center_inside(F.col("f.box"), F.col("c.box")))
    owner = hits.groupBy(*[f"f.{k}" for k in keys], "f.ordinal").agg(F.min("c.cell_no").alias("cell_no"), F.first("f.text").alias("text"), F.first("f.box").alias("box"))
    entry = F.struct(F.col("box.y").alias("y"), F.col("box.x").alias("x"), "ordinal", T.strip(F.col("text")).alias("text"), F.col("box.w").alias("w"), F.col("box.h").alias("h"))
    said = owner.groupBy(*keys, "cell_no").agg(written_in(F.array_sort(F.collect_list(entry))).alias("text"), F.count("*").alias("n_fragments"))
    body = [c for c in cells.columns if c not in ("text", "n_fragments")]
    return cells.select(*body).join(said, [*keys, "cell_no"], "left").select(*body, F.coalesce("text", F.lit("")).alias("text"), F.coalesce("n_fragments", F.lit(0)).alias("n_fragments"))


def suspicious(text: Column) -> Column:
    """Blank, or one Latin letter or mark that stands for something unread."""
    return T.strip(F.coalesce(text, F.lit(""))).rlike("^[A-Za-z?*_-]?$")


def filled_from_page(cells: DataFrame, lines: DataFrame) -> DataFrame:
    """``cells`` (doc_id, page_index, cell_no, text, box) whose text is suspicious with that of the page's lines (line_no, text, box) centred in them; ``page_text_fallback`` tells which."""
    poor = cells.where(suspicious(F.col("text"))).select(*PAGE, "cell_no", "box")
    hits = poor.alias("c").join(lines.where(T.strip(F.col("text")) != "").alias("l"), same_page("c", "l") & G.center_inside(F.col("l.box"), F.col("c.box")))
    entry = F.struct(F.col("l.box.y").alias("y"), F.col("l.box.x").alias("x"), F.col("l.line_no").alias("line_no"), T.strip(F.col("l.text")).alias("text"))
    found = hits.groupBy("c.doc_id", "c.page_index", "c.cell_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"]), "").alias("_read"))
    joined = cells.join(found, [*PAGE, "cell_no"], "left")
    return joined.select(*[F.coalesce("_read", "text").alias("text") if c == "text" else F.col(c) for c in cells.columns], F.col("_read").isNotNull().alias("page_text_fallback"))


def pipe_rows(cells: DataFrame, *keys: str) -> DataFrame:
    """(keys, markdown): a pipe table of cells (row_index, col_index, text, box), columns being the places of a row's cells from left to right.

    Cells of one col_index are so told apart. What stands in columns headed as ones of pictures is left out.
    """
    entry = F.struct("col_index", F.col("box.x").alias("x"), T.squeeze(F.col("text")).alias("text"))
    rows = cells.groupBy(*keys, "row_index").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"]).alias("texts"))
    table = rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("row_index", "texts"))), lambda r: r["texts"]).alias("rows"))

    def rendered(rows: Column) -> Column:
        head = rows[0]
        shown = lambda r, n: F.when(n == 0, r).otherwise(F.transform(r, lambda c, i: F.when(F.coalesce(F.get(head, i).isin(*PICTURE_HEADERS), F.lit(False)), F.lit("")).otherwise(c)))
        lines = F.transform(rows, lambda r, n: F.concat(F.lit("| "), F.array_join(F.transform(shown(r, n), lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))), " | "), F.lit(" |")))
        rule = F.concat(F.repeat(F.lit("| --- "), F.size(head)), F.lit("|"))
        return F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, F.size(rows))), "\n")

    return table.select(*keys, T.let(F.col("rows"), rendered).alias("markdown"))


def separate_footers(markdown: Column) -> Column:
    """What follows a pipe row on its line, after an empty line."""
    return F.regexp_replace(markdown, r"(?m)^(\|.*\|)[ \t]*([^|\s][^|\n]*)$", "$1\n\n$2")


def with_seals(markdown: Column, layout_texts: Column, images: Column, recognised: Column) -> Column:
    """A Markdown text with one section of seals at its end, of the recognised texts, or of the layout's where none were recognised.

    Where there is something to show, a section that closes the text already (``markdown.segments``) goes, and so do the pictures of
    seals and the lines that the layout read off them; running it again changes nothing. The title elsewhere in the text is text, and
    without anything to show the text stays as it is.
    """
    none = F.array().cast("array<string>")
    clean = lambda a: F.filter(F.transform(F.coalesce(a, none), T.strip), lambda t: t != "")

    def closed(v: Column) -> Column:
        drop = F.concat(v["own"], v["found"], F.transform(v["images"], lambda p: F.concat(F.lit("![]("), p, F.lit(")"))))
        shown = F.array_distinct(F.when(F.size(v["found"]) > 0, v["found"]).otherwise(v["own"]))
        body = F.when(F.size(shown) > 0, M.joined(F.filter(M.segments(v["text"]), lambda s: s["kind"] != "seal"))).otherwise(v["text"])
        lines = F.filter(F.split(body, "\n", -1), lambda x: ~F.array_contains(drop, T.strip(x)))
        kept = T.strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))
        section = F.concat(F.lit(M.SEAL_TITLE + "\n\n"), F.array_join(shown, "\n"))
        whole = T.let(kept, lambda k: F.when(k == "", section).otherwise(F.concat_ws("\n\n", k, section)))
        rest = F.concat(kept, F.lit("\n"))
        return F.when(F.size(shown) > 0, F.concat(whole, F.lit("\n"))).when(F.size(v["images"]) > 0, rest).otherwise(v["text"])

    given = F.struct(F.coalesce(markdown, F.lit("")).alias("text"), clean(layout_texts).alias("own"), clean(recognised).alias("found"), clean(images).alias("images"))
    return T.let(given, closed)


# Modes whose recognised blocks replace a document's text, and the type of blocks read off seals.
TWO_COLUMN_MODES, SEAL_MODES, SEAL_BLOCK = ("ppocrv5",), ("seal_vl_crops_ppocrv5",), "seal_text"


def rebuilt_markdown(documents: DataFrame, blocks: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """(doc_id, markdown): documents' Markdown made anew from what was recognised, by the mode of the recognition.

    ``documents``: doc_id, markdown, mode; ``blocks``: keys, block_type, text, box; ``cells``: keys, table_no, row_index, col_index, text, box.
    In modes of whole pages the lines of the blocks, halves joined, become the text; in modes of seals the blocks do, seals in the closing section; in other modes
    the text's pipe tables become those of the cells, in order of page and table. Documents of which nothing was recognised keep their text.
    """
    one_of = documents.select("doc_id", "mode", "markdown")
    plain = blocks.join(one_of.select("doc_id", "mode"), "doc_id").where(T.strip(F.coalesce("text", F.lit(""))) != "")
    body = plain.where(F.col("mode").isin(*TWO_COLUMN_MODES) | (F.col("mode").isin(*SEAL_MODES) & (F.coalesce("block_type", F.lit("")) != SEAL_BLOCK)))
    middle = body.groupBy(*PAGE).agg(((F.min("box.x") + F.max(F.col("box.x") + F.col("box.w"))) / 2).alias("middle"))
    lines = column_lines(reading_order(body).join(middle, [*PAGE]), F.col("middle"))
    entry = F.struct("page_index", "line", "text")
    read = lines.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: T.strip(e["text"])), "\n\n").alias("read"))
    seal = plain.where(F.col("mode").isin(*SEAL_MODES) & (F.col("block_type") == SEAL_BLOCK))
    place = F.struct("page_index", F.col("box.y").alias("y"), F.col("box.x").alias("x"), T.strip(F.col("text")).alias("text"))
    seals = seal.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(place)), lambda e: e["text"]).alias("seals"))
    out = one_of.join(read, "doc_id", "left").join(seals, "doc_id", "left")
    if cells is not None:
        table = pipe_rows(cells, *PAGE, "table_no")
        made = table.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_index", "table_no", "markdown"))), lambda e: e["markdown"]).alias("tables"))
        out = out.join(made, "doc_id", "left")
    else:
        out = out.withColumn("tables", F.lit(None).cast("array<string>"))
    none = F.array().cast("array<string>")
    anew = F.coalesce(F.concat("read", F.lit("\n")), F.lit(""))
    by_blocks = F.when(F.col("mode").isin(*SEAL_MODES), with_seals(anew, none, none, F.col("seals"))).otherwise(anew)
    whole = F.col("read").isNotNull() | F.col("seals").isNotNull()
    text = F.coalesce("markdown", F.lit(""))
    by_cells = F.when(F.col("tables").isNotNull(), M.rebuilt_tables(separate_footers(text), F.col("tables"))).otherwise(text)
    return out.select("doc_id", F.when(whole, by_blocks).when(F.col("mode").isin(*TWO_COLUMN_MODES, *SEAL_MODES), text).otherwise(by_cells).alias("markdown"))
