"""Keyword search with coordinates over text blocks and table cells.

The match key of a text is computed once; keywords are a list of the caller's, few as part of the plan and many in one
automaton, so texts are neither shuffled nor multiplied by keywords without a match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from . import patterns

#: Most keywords of one search; the caller's list, not data.
MOST_KEYWORDS = 10_000
#: Most keywords that are part of the plan.
FEW = patterns.PLAIN
SOURCES = ("table_cell", "paddle_text", "mineru_text", "unknown")


def keyword_table(spark: SparkSession, keywords: list[str] | str) -> DataFrame:
    """(keyword, key) of a list, split, trimmed, one of each key, the first kept."""
    items = [keywords] if isinstance(keywords, str) else list(keywords)
    if len(items) > MOST_KEYWORDS:
        raise ValueError(f"at most {MOST_KEYWORDS} keywords")
    given = spark.createDataFrame(list(enumerate(items)), "item int, given string")
    split = given.select("item", F.posexplode(T.split_keywords(F.col("given"))).alias("part", "keyword")).withColumn("key", T.match_key(F.col("keyword")))
    first = F.min(F.struct("item", "part", "keyword"))
    return split.where("key <> ''").groupBy("key").agg(first.getField("keyword").alias("keyword"))


def searchable(rows: DataFrame, source: str, *, provider: Column | None = None) -> DataFrame:
    """Rows (doc_id, page_index, text, box) as search input, with the class and rank of their source."""
    kind = source_class(F.lit(source), provider if provider is not None else F.lit(""))
    return rows.where("box is not null").select("doc_id", "page_index", "text", "box", F.lit(source).alias("source"), kind.alias("source_class"))


def source_class(source: Column, *origins: Column) -> Column:
    """Table cells, texts of the table recogniser, other texts, or unknown."""
    every = F.lower(F.concat_ws(" ", source, *origins))
    return (
        F.when(source == "table_cell", F.lit("table_cell"))
        .when(every.contains("paddle") | every.contains("ppstructure"), F.lit("paddle_text"))
        .when(F.trim(every) != "", F.lit("mineru_text"))
        .otherwise(F.lit("unknown"))
    )


def source_rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SOURCES)), kind) - 1


def matches(rows: DataFrame, keywords: DataFrame) -> DataFrame:
    """Rows by keyword where the key of the text holds the keyword's. ``keywords`` are the caller's list, ``MOST_KEYWORDS`` at most.

    A text's key is computed once. Few keywords meet it as an array in its own row; many are found by one automaton in one pass. Either way
    texts are not joined to keywords, and a text without a match is not multiplied.
    """
    words = listed(keywords)
    if len(words) > patterns.PLAIN:
        keyed = rows.withColumn("text_key", T.match_key(F.col("text")))
        found = patterns.held(keyed, keywords, word="key", text="text_key").withColumnRenamed("word", "key")
        return found.join(F.broadcast(keywords.select("key", "keyword")), "key").select(*rows.columns, "text_key", "keyword")
    found = lambda key: F.struct(key.alias("text_key"), _held(key, words).alias("keywords"))
    keyed = rows.withColumn("_found", T.let(T.match_key(F.col("text")), found))
    return keyed.select(*rows.columns, F.col("_found.text_key").alias("text_key"), F.explode("_found.keywords").alias("keyword"))


def listed(keywords: DataFrame) -> list[tuple[str, str]]:
    """(keyword, key) of the caller's list."""
    words = [(r["keyword"], r["key"]) for r in keywords.select("keyword", "key").limit(MOST_KEYWORDS + 1).collect()]
    if len(words) > MOST_KEYWORDS:
        raise ValueError(f"at most {MOST_KEYWORDS} keywords")
    return words


def _held(key: Column, words: list[tuple[str, str]]) -> Column:
    """The keywords whose keys a text's key holds."""
    pairs = F.array(*[F.struct(F.lit(w).alias("keyword"), F.lit(k).alias("key")) for w, k in words]).cast("array<struct<keyword: string, key: string>>")
    return F.transform(F.filter(pairs, lambda w: key.contains(w["key"])), lambda w: w["keyword"])


def matches_of_page(blocks: Column, cells: Column, words: list[tuple[str, str]]) -> Column:
    """The number of ``field_search``'s rows of a page, of arrays of its blocks and cells (struct with box and sought, the match key of a text) and ``FEW`` keywords at most."""
    if not words:
        return F.lit(0)

    def found(items: Column) -> Column:
        keyed = F.transform(F.filter(items, lambda b: b["box"].isNotNull()), lambda b: F.struct(b["sought"].alias("key"), _held(b["sought"], words).alias("words"), b["box"].alias("box")))
        side = lambda b, n: F.bround(b["box"][n].cast("double"), 1).alias(n)
        one = lambda b, w: F.struct(w.alias("keyword"), b["key"].alias("key"), *[side(b, n) for n in "xywh"])
        return F.array_distinct(F.flatten(F.transform(F.filter(keyed, lambda b: F.size(b["words"]) > 0), lambda b: F.transform(b["words"], lambda w: one(b, w)))))

    name = lambda f: F.struct(f["keyword"].alias("keyword"), f["key"].alias("key"))
    # texts of cells rank before those of blocks
    rest = lambda of: F.size(of["blocks"]) - F.size(F.filter(of["blocks"], lambda f: F.array_contains(of["names"], name(f))))
    both = T.let(found(cells), lambda c: F.struct(c.alias("cells"), F.transform(c, name).alias("names"), found(blocks).alias("blocks")))
    return T.let(both, lambda of: F.size(of["cells"]) + rest(of)).cast("bigint")


def distinct_matches(found: DataFrame) -> DataFrame:
    """One of each (keyword, page, rounded box, text); where sources differ on a text, only those of the best rank.

    The first step is an aggregate and thus reduced before its shuffle. The second shares its window's
    partitioning with nothing hotter than one keyword and text on one page.
    """
    side = lambda n: F.bround(F.col(f"box.{n}").cast("double"), 1)
    key = ["doc_id", "keyword", "page_index", "text_key", *[f"k{n}" for n in "xywh"]]
    best = F.struct(source_rank(F.col("source_class")).alias("rank"), "source", "source_class", "text", "box")
    one = found.select("*", *[side(n).alias(f"k{n}") for n in "xywh"]).groupBy(*key).agg(F.min(best).alias("m"))
    group = Window.partitionBy("doc_id", "keyword", "page_index", "text_key")
    ranked = one.withColumn("least", F.min("m.rank").over(group))
    return ranked.where("m.rank = least").select("doc_id", "keyword", "page_index", "m.text", "m.box", "m.source", "m.source_class")


def field_search(blocks: DataFrame, cells: DataFrame, keywords: DataFrame) -> DataFrame:
    """Matches of the keywords in blocks and cells, with page number and corner points."""
    rows = searchable(blocks, "mineru_text_block").unionByName(searchable(cells, "table_cell"))
    found = distinct_matches(matches(rows, keywords))
    return found.select("*", (F.col("page_index") + 1).alias("page_number"), G.quad_points(F.col("box")).alias("quad_points"))


def in_order(found: DataFrame) -> DataFrame:
    """O4"""
    return found.orderBy("doc_id", "page_index", "box.y", "box.x", "keyword")


def coordinates(found: DataFrame, *keys: str) -> DataFrame:
    """K8: one row per document: its matches in order and their number."""
    entry = F.struct("page_index", F.col("box.y").alias("y"), F.col("box.x").alias("x"), "keyword", "text", "source", "box", "quad_points")
    return found.groupBy(*(keys or ("doc_id",))).agg(F.array_sort(F.collect_list(entry), _by_place).alias("matches"), F.count("*").alias("match_count"))


def _by_place(a: Column, b: Column) -> Column:
    out = F.lit(0)
    for name in ("keyword", "x", "y", "page_index"):
        out = F.when(a[name] < b[name], F.lit(-1)).when(a[name] > b[name], F.lit(1)).otherwise(out)
    return out
