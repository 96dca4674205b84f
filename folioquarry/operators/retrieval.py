"""Ranked retrieval of pages: an inverted index as tables, and BM25 with bounds of blocks. R10

The index has a row for each term of each page (its impact: the part of BM25 that does not depend on the query), the greatest impact of a
term in each block of pages, and a weight for each term. Pages are dealt to blocks by a hash, so a term that all pages have is spread over all blocks.

A list of queries of bounded size (``DENSE``) is asked of all pages at once: of the postings only those of asked terms are read, which are grouped by page, and tasks keep
their k best pages of each query, so what is shuffled grows neither with queries by pages nor with the words of pages. An index that was just built has its
postings grouped by page already.

Longer lists are asked by blocks. A query then never scans all pages: its terms meet the greatest impacts, by an equality join, which bounds the score of any page of a block. The
few blocks of greatest bounds are scored first; their k-th best score is a threshold, and of the other blocks only those are scored whose bound reaches it.
The bound holds for every page, so results are exact.

Defined results: terms are runs of letters and digits in lower case; a query's terms count once; pages without terms are not in the index;
queries without terms, or without a page that has one, have no rows. Scores are rounded to ``DIGITS`` places, and ties are in order of document and page.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .base import checkpointed, in_batches
from .spatial import PAGE

#: Parameters of BM25.
SATURATION, LENGTH = 1.2, 0.75
#: Pages of a block; blocks that are scored before there is a threshold; places of scores.
BLOCK, FIRST, DIGITS = 2048, 8, 6
#: Terms by queries of a list that is asked of all pages at once (a matrix of weights that each task holds); pages that are scored at once.
DENSE, PAGES = 1 << 22, 256


@dataclass(frozen=True)
class Index:
    """``postings``: term, block, doc_id, page_index, impact; ``maxima``: term, block, top; ``terms``: term, df, weight."""

    postings: DataFrame
    maxima: DataFrame
    terms: DataFrame


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _counted(terms: Column) -> Column:
    """struct<term, tf> of each distinct term of a page: counted in its sorted array, so that no aggregate holds, or spills, the words of all pages."""
    starts = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
    runs = lambda s, p: F.transform(p, lambda i, j: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(p, j + 1), F.size(s)) - i).alias("tf")))
    return T.let(F.sort_array(terms), lambda s: T.let(starts(s), lambda p: runs(s, p)))


def build(pages: DataFrame) -> Index:
    """The index of pages (doc_id, page_index, text)."""
    split = pages.select(*PAGE, terms_of(F.col("text")).alias("terms")).where(F.size("terms") > 0).withColumn("n", F.size("terms"))
    n_pages, n_words = split.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    mean = n_words / n_pages if n_pages else 1.0
    blocks = max(1, math.ceil(n_pages / BLOCK))
    counted = split.select(*PAGE, "n", F.explode(_counted(F.col("terms"))).alias("t")).select(*PAGE, "n", "t.term", "t.tf")
    impact = F.col("tf") * (SATURATION + 1) / (F.col("tf") + SATURATION * (1 - LENGTH + LENGTH * F.col("n") / mean))
    postings = counted.select("term", F.pmod(F.xxhash64(*PAGE), F.lit(blocks)).cast("int").alias("block"), *PAGE, impact.alias("impact"))
    maxima = postings.groupBy("term", "block").agg(F.max("impact").alias("top"))
    # of the postings themselves, so that a semi join with asked terms reaches the words of pages
    df = postings.groupBy("term").agg(F.count("*").alias("df"))
    weight = F.log1p((F.lit(n_pages) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return Index(postings, maxima, df.select("term", "df", weight.alias("weight")))


def write(index: Index, path: str) -> None:
    """The index as three tables; postings are in order of term and block, so that a query's terms prune files and row groups."""
    index.postings.repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.mode("overwrite").parquet(f"{path}/postings")
    written = index.postings.sparkSession.read.parquet(f"{path}/postings")
    written.groupBy("term", "block").agg(F.max("impact").alias("top")).repartitionByRange("term").sortWithinPartitions("term", "block").write.mode("overwrite").parquet(f"{path}/maxima")
    index.terms.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/terms")


def read(spark: SparkSession, path: str) -> Index:
    return Index(*(spark.read.parquet(f"{path}/{name}") for name in ("postings", "maxima", "terms")))


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query; Spark keeps k of a partition's before it shuffles them."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), *PAGE))
    return scored.withColumn("place", place).where(F.col("place") <= k)


def search(index: Index, queries: DataFrame, k: int = 10, first: int = FIRST) -> DataFrame:
    """(query_id, place, doc_id, page_index, score): the k best pages of each query (query_id, text)."""
    asked = queries.select("query_id", F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term")).distinct()
    asked = checkpointed(asked)
    n_terms, n_queries = asked.agg(F.count_distinct("term"), F.count_distinct("query_id")).first()
    if n_terms * n_queries <= DENSE:
        return _at_once(index, asked, k)
    return _by_blocks(index, checkpointed(asked.join(index.terms.select("term", "weight"), "term")), k, first)


def _best_of_task(weights: np.ndarray, k: int):
    """Batches of pages with their asked terms to (query_no, doc_id, page_index, score) of a task's k best pages of each query."""

    def scored(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        numbers, impacts = batch.column("numbers"), batch.column("impacts")
        at, n, x = numbers.offsets.to_numpy(), numbers.values.to_numpy(), impacts.values.to_numpy()
        for start in range(0, batch.num_rows, PAGES):
            stop = min(start + PAGES, batch.num_rows)
            raw = np.stack([x[at[i] : at[i + 1]] @ weights[n[at[i] : at[i + 1]]] for i in range(start, stop)])
            page, query = np.nonzero((raw > 0) & (np.floor(raw * 10.0**DIGITS + 0.5) / 10.0**DIGITS >= least))
            yield start + page, query, np.floor(raw[page, query] * 10.0**DIGITS + 0.5) / 10.0**DIGITS

    least = np.full(weights.shape[1], -1.0)

    def best(held: pa.Table) -> pa.Table:
        order = [("query_no", "ascending"), ("score", "descending"), *((c, "ascending") for c in PAGE)]
        held = held.take(pc.sort_indices(held, sort_keys=order, null_placement="at_start"))
        query = held.column("query_no").to_numpy()
        place = np.arange(len(query)) - np.searchsorted(query, query)
        last = place == k - 1
        least[query[last]] = held.column("score").to_numpy()[last]
        return held.filter(pa.array(place < k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            keys = pa.Table.from_batches([batch.select(list(PAGE))])
            for page, query, score in scored(batch):
                if len(page):
                    more = keys.take(pa.array(page)).add_column(0, "query_no", pa.array(query.astype(np.int32))).append_column("score", pa.array(score))
                    held = best(more if held is None else pa.concat_tables([held, more]))
        if held is not None:
            yield from held.combine_chunks().to_batches()

    return run


def _at_once(index: Index, asked: DataFrame, k: int) -> DataFrame:
    """The k best pages of each of few queries (query_id, term): a page is scored for all of them where its postings are."""
    terms = index.terms.join(F.broadcast(asked.select("term").distinct()), "term", "left_semi").select("term", "weight")
    number = lambda c: (F.dense_rank().over(Window.orderBy(c)) - 1).cast("int")
    known = checkpointed(asked.join(terms, "term").select("query_id", "term", "weight", number("query_id").alias("query_no"), number("term").alias("term_no")))
    rows = known.select("query_no", "term_no", "weight").collect()
    weights = np.zeros((max((r.term_no for r in rows), default=-1) + 1, max((r.query_no for r in rows), default=-1) + 1))
    for r in rows:
        weights[r.term_no, r.query_no] = r.weight
    numbers = F.broadcast(known.select("term", "term_no").distinct())
    met = index.postings.join(F.broadcast(known.select("term").distinct()), "term", "left_semi").join(numbers, "term")
    pages = met.groupBy(*PAGE).agg(F.collect_list("term_no").alias("numbers"), F.collect_list("impact").alias("impacts"))
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    found = in_batches(pages, _best_of_task(weights, k), f"query_no int, {', '.join(f'{c} {kinds[c]}' for c in PAGE)}, score double")
    named = found.join(F.broadcast(known.select("query_no", "query_id").distinct()), "query_no")
    return _best(named, k).select("query_id", "place", *PAGE, "score")


def _by_blocks(index: Index, asked: DataFrame, k: int, first: int) -> DataFrame:
    """The k best pages of each query (query_id, term, weight), by bounds of blocks."""
    bounds = checkpointed(asked.join(index.maxima, "term").groupBy("query_id", "block").agg(F.sum(F.col("weight") * F.col("top")).alias("bound")))

    def scored(opened: DataFrame) -> DataFrame:
        wanted = opened.select("query_id", "block").join(asked, "query_id")
        met = wanted.join(index.postings, ["term", "block"])
        return met.groupBy("query_id", *PAGE).agg(F.round(F.sum(F.col("weight") * F.col("impact")), DIGITS).alias("score"))

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "block"))
    begun = bounds.withColumn("rank", rank).where(F.col("rank") <= first).select("query_id", "block")
    some = checkpointed(_best(scored(begun), k).drop("place"))
    least = some.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("had"))
    least = least.select("query_id", F.when(F.col("had") >= k, F.col("least")).otherwise(0.0).alias("least"))
    rest = bounds.join(begun, ["query_id", "block"], "left_anti").join(least, "query_id", "left")
    # a bound may be off by what sums and scores are rounded by
    open_ = rest.where(F.col("bound") + 10.0**-DIGITS >= F.coalesce("least", F.lit(0.0)))
    return _best(some.unionByName(scored(open_)), k).select("query_id", "place", *PAGE, "score")
