"""Spatial joins of boxes on the same page.

The page is always an equality key, so these are hash or sort-merge joins with a geometric condition,
never cross joins; a page's rows are few, whatever the corpus. "First match" is a minimum over an ordinal, which
is pre-aggregated, rather than a sort of all matches.

Crowded pages. Where pages may have many thousands of boxes, ``by_tile`` makes tiles a key too: each box is dealt to the tiles that it covers, of a
size that fits its own, and to those of the larger sizes, and two boxes meet in the first tile that they share at the larger of their sizes. A page then costs as much as it has pairs that are
near each other. It holds for tests that only boxes pass that touch, or, with ``reach``, come as near as that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T

PAGE = ("doc_id", "page_index")
Test = Callable[[Column, Column], Column]


def same_page(a: str, b: str) -> Column:
    return (F.col(f"{a}.doc_id") == F.col(f"{b}.doc_id")) & (F.col(f"{a}.page_index") == F.col(f"{b}.page_index"))


def at_least(measure: Callable[[Column, Column], Column], least: float) -> Test:
    return lambda a, b: measure(a, b) >= least


#: Sides of the smallest tiles, how many times larger those of the next level are, and levels. A box is of the first level whose tiles are half as wide as it at least.
TILE, LARGER, LEVELS = 64, 8, 4


def _tiles(box: Column, reach: float) -> tuple[Column, Column]:
    """The level of a box, and its tiles (level, tx, ty) from that level up."""
    x, y = box["x"] - reach, box["y"] - reach
    w, h = F.greatest(box["w"], F.lit(0)) + 2 * reach, F.greatest(box["h"], F.lit(0)) + 2 * reach
    side = lambda k: TILE * LARGER**k
    level = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        level = F.when(F.greatest(w, h) <= 2 * side(k), F.lit(k)).otherwise(level)
    of = lambda at, size, k: F.sequence(F.floor(at / side(k)).cast("int"), F.floor((at + size) / side(k)).cast("int"))
    covered = lambda k: F.flatten(F.transform(of(x, w, k), lambda tx: F.transform(of(y, h, k), lambda ty: F.struct(F.lit(k).alias("level"), tx.alias("tx"), ty.alias("ty")))))
    none = F.array().cast("array<struct<level: int, tx: int, ty: int>>")
    return level, F.concat(*[F.when(level <= k, covered(k)).otherwise(none) for k in range(LEVELS)])


def by_tile(left: DataFrame, right: DataFrame, test: Test, reach: float = 0.0) -> DataFrame:
    """``pairs`` with tiles as a key; columns are l.* and r.*, structs of the rows of either side. Boxless rows pair with nothing."""

    def dealt(rows: DataFrame, side: str, reach: float) -> DataFrame:
        level, tiles = _tiles(F.col("box"), reach)
        row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias(side)
        own = rows.where("box IS NOT NULL").select(row, *PAGE, level.alias("own"), tiles.alias("tiles"))
        return own.select(side, *PAGE, "own", F.explode("tiles").alias("t"), F.col("tiles").alias("all")).select(
            side, F.col("doc_id").alias("_doc"), F.col("page_index").alias("_page"), F.col("own").alias(f"{side}_own"), "t.level", "t.tx", "t.ty",
            F.array_min(F.transform(F.filter("all", lambda a: a["level"] == F.col("t.level")), lambda a: a["tx"])).alias(f"{side}_tx"),
            F.array_min(F.transform(F.filter("all", lambda a: a["level"] == F.col("t.level")), lambda a: a["ty"])).alias(f"{side}_ty"),
        )

    met = dealt(left, "l", reach).join(dealt(right, "r", 0.0), ["_doc", "_page", "level", "tx", "ty"])
    once = (F.col("level") == F.greatest("l_own", "r_own")) & (F.col("tx") == F.greatest("l_tx", "r_tx")) & (F.col("ty") == F.greatest("l_ty", "r_ty"))
    return met.where(once & test(F.col("l.box"), F.col("r.box"))).select("l", "r")


def pairs(left: DataFrame, right: DataFrame, test: Test) -> DataFrame:
    """All pairs on a page that pass; columns are l.* and r.* under aliases l and r."""
    return left.alias("l").join(right.alias("r"), same_page("l", "r") & test(F.col("l.box"), F.col("r.box")))


def outside(blocks: DataFrame, regions: DataFrame, test: Test = G.center_inside, exempt: Column | None = None, crowded: bool = False, key: str = "line_no") -> DataFrame:
    """Blocks that pass the test with no region of their page; exempt and boxless blocks always stay. On ``crowded`` pages, whose blocks ``key`` numbers, tiles are a key too."""
    if crowded:
        near = by_tile(blocks.select(*PAGE, key, "box") if exempt is None else blocks.alias("b").where(~F.coalesce(exempt, F.lit(False))).select(*PAGE, key, "box"), regions.select(*PAGE, "box"), test)
        return blocks.join(near.select("l.doc_id", "l.page_index", f"l.{key}").distinct(), [*PAGE, key], "left_anti")
    hit = same_page("b", "r") & test(F.col("b.box"), F.col("r.box")) & F.col("b.box").isNotNull() & F.col("r.box").isNotNull()
    if exempt is not None:
        hit = hit & ~F.coalesce(exempt, F.lit(False))
    return blocks.alias("b").join(regions.alias("r"), hit, "left_anti")


def first_match(blocks: DataFrame, regions: DataFrame, test: Test, ordinal: str = "ordinal", key: str = "line_no", crowded: bool = False, reach: float = 0.0) -> DataFrame:
    """(doc_id, page_index, key, region) of blocks with a region, the first by its ordinal. On ``crowded`` pages tiles are a key too; ``reach`` is how far apart boxes may pass the test."""
    if crowded:
        near = by_tile(blocks.select(*PAGE, key, "box"), regions.select(*PAGE, ordinal, "box"), test, reach)
        return near.groupBy("l.doc_id", "l.page_index", f"l.{key}").agg(F.min(f"r.{ordinal}").alias("region"))
    found = blocks.alias("b").join(regions.alias("r"), same_page("b", "r") & test(F.col("b.box"), F.col("r.box")))
    return found.groupBy("b.doc_id", "b.page_index", f"b.{key}").agg(F.min(f"r.{ordinal}").alias("region"))


def near_region(a: Column, b: Column) -> Column:
    """Whether a block belongs to a seal region: it overlaps, or its centre is close."""
    return (G.overlap(a, b) >= 0.05) | (G.center_distance(a, b) <= 1.4)


def fill_cells(cells: DataFrame, blocks: DataFrame, crowded: bool = False, shown: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """(doc_id, page_index, cell_no, text, n_blocks, confidence) of cells that hold block centres.

    A block goes to the first cell (by cell_no) around its centre; a cell's text is its blocks' from top to
    bottom, then left to right, each as ``shown``. Which cell a block goes to does not depend on other blocks, so a minimum decides.
    """
    usable = blocks.where(T.strip(F.col("text")) != "")
    if crowded:
        hits = by_tile(usable.select(*PAGE, "line_no", "text", "box", "confidence"), cells.select(*PAGE, "cell_no", "box"), G.center_inside).select(F.col("l").alias("b"), F.col("r").alias("c"))
    else:
        hits = usable.alias("b").join(cells.alias("c"), same_page("b", "c") & G.center_inside(F.col("b.box"), F.col("c.box")))
    owner = hits.groupBy("b.doc_id", "b.page_index", "b.line_no").agg(
        F.min("c.cell_no").alias("cell_no"), F.first("b.text").alias("text"), F.first("b.box").alias("box"), F.first("b.confidence").alias("confidence")
    )
    entry = F.struct(F.col("box.y").alias("y"), F.col("box.x").alias("x"), "line_no", "text")
    return owner.groupBy(*PAGE, "cell_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: shown(e["text"])), "\n").alias("text"),
        F.count("*").alias("n_blocks"), F.avg("confidence").alias("confidence"),
    )


def greedy_match(tables: DataFrame, candidates: DataFrame, least: float = 0.70) -> DataFrame:
    """(doc_id, page_index, table_no, candidate_no or null): each table, in order, takes its first unused candidate of enough IoU.

    What a table may take depends on those before it, so a page is folded in order; only the page's pairs
    that overlap enough enter the fold.
    """
    near = tables.alias("t").join(
        candidates.alias("c"), same_page("t", "c") & G.touching(F.col("t.box"), F.col("c.box")) & (G.iou(F.col("t.box"), F.col("c.box")) >= least), "left"
    ).groupBy("t.doc_id", "t.page_index", "t.table_no").agg(F.array_sort(F.collect_list("c.candidate_no")).alias("options"))
    page = near.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("table_no", "options"))).alias("tables"))
    start = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast("array<struct<table_no: int, candidate_no: int>>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        chosen = F.try_element_at(F.filter(t["options"], lambda o: ~F.array_contains(acc["used"], o)), F.lit(1))
        used = F.when(chosen.isNull(), acc["used"]).otherwise(F.array_append(acc["used"], chosen))
        return F.struct(used.alias("used"), F.array_append(acc["out"], F.struct(t["table_no"].alias("table_no"), chosen.alias("candidate_no"))).alias("out"))

    folded = page.select(*PAGE, F.explode(F.aggregate("tables", start, step, lambda acc: acc["out"])).alias("m"))
    return folded.select(*PAGE, "m.table_no", "m.candidate_no")


def annotate(blocks: DataFrame, marks: DataFrame, least: float = 0.12) -> DataFrame:
    """``blocks`` with the ordinals of the marks put on them; marks that meet no block are appended as blocks.

    A mark goes to the first block (by line_no) that it overlaps enough, or is appended after all blocks, where a
    later mark may meet it: marks are folded in order, over the ones appended.
    """
    met = marks.alias("m").join(blocks.alias("b"), same_page("m", "b") & (G.overlap(F.col("b.box"), F.col("m.box")) >= least), "left")
    met = met.groupBy("m.doc_id", "m.page_index", "m.ordinal").agg(F.min("b.line_no").alias("line_no"), F.first("m.box").alias("box"), F.first("m.text").alias("text"))
    free = met.where("line_no is null").groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("ordinal", "box", "text"))).alias("marks"))
    start = F.array().cast("array<struct<ordinal: int, box: struct<x: int, y: int, w: int, h: int>, text: string, onto: int>>")

    def step(acc: Column, m: Column) -> Column:
        first = F.try_element_at(F.filter(acc, lambda a: a["onto"].isNull() & (G.overlap(a["box"], m["box"]) >= least)), F.lit(1))
        return F.array_append(acc, F.struct(m["ordinal"].alias("ordinal"), m["box"].alias("box"), m["text"].alias("text"), first["ordinal"].alias("onto")))

    appended = free.select(*PAGE, F.explode(F.aggregate("marks", start, step)).alias("a")).select(*PAGE, "a.ordinal", "a.box", "a.text", "a.onto")
    on_block = met.where("line_no is not null").groupBy(*PAGE, "line_no").agg(F.array_sort(F.collect_list("ordinal")).alias("marks"))
    on_mark = appended.where("onto is not null").groupBy(*PAGE, F.col("onto").alias("ordinal")).agg(F.array_sort(F.collect_list("ordinal")).alias("marks"))
    none = F.array().cast("array<int>")
    own = blocks.join(on_block, [*PAGE, "line_no"], "left").select(*PAGE, "line_no", "text", "box", F.coalesce("marks", none).alias("marks"))
    new = appended.where("onto is null").drop("onto").join(on_mark, [*PAGE, "ordinal"], "left")
    return own.unionByName(new.select(*PAGE, (-F.col("ordinal") - 1).alias("line_no"), "text", "box", F.coalesce("marks", none).alias("marks")))


def confirmed(blocks: DataFrame, others: DataFrame, key: str = "line_no") -> DataFrame:
    """Blocks of which an overlapping text on the page says nearly the same.

    Pairs that meet on the page are decided by containment where they can be, in the JVM; of the rest, those of like length
    go to Python, each two keys once.
    """
    left = blocks.select(*PAGE, key, "box", T.canonical_key(F.col("text")).alias("own"))
    right = others.select(*PAGE, F.col("box").alias("other_box"), T.canonical_key(F.col("text")).alias("other"))
    near = left.join(right, [*PAGE]).where(G.touching(F.col("box"), F.col("other_box")) & (G.overlap(F.col("box"), F.col("other_box")) >= 0.05))
    own, other = F.col("own"), F.col("other")
    sure = T.one_holds_other(own, other)
    of_block = near.where(sure | T.undecided(own, other)).groupBy(*PAGE, key, "own").agg(
        F.bool_or(sure).alias("sure"), F.collect_set(F.when(~sure, other)).alias("others")
    )
    # blocks that are sure need no more; the others compare their text with few
    rest = of_block.where("not sure").select(*PAGE, key, "own", F.explode("others").alias("other"))
    return of_block.where("sure").select(*PAGE, key).unionByName(rest.where(T.alike(own, other)).select(*PAGE, key)).distinct()
