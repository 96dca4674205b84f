"""Mixing sources to target weights by hash-threshold histograms. DataFrame functions only.

A source's target is its weighted share of the budget, capped at ``max_repeats`` times its size;
what a cap cuts off is reshared by weight until no source is above its cap (water filling).
A target of c whole copies plus a rest is met by taking every document c times and, for the rest,
the documents whose hash lies below a threshold of their source.

The threshold comes from histograms, never from a sort of documents: tokens are summed by source
and hash bucket, the bucket in which the running sum passes the rest is the boundary, and only its
rows are summed again over the next bits of the hash. Budgets are nested: a larger one takes a
superset. Histograms are pre-aggregated before they shuffle, so a source with a third of all rows
costs ``2 ** BITS`` rows per task. Table sizes: sources, and sources x buckets.

Ties. Rows of one id, or without an id, have one hash. Where the boundary falls among several of them, it is sought in the same way among
these rows only, by a hash of their contents, and among rows that are equal in that too by a number drawn for each row and written down; such rows
are interchangeable, so reruns agree. A source meets its target to within a document, whatever its ids.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a source without words has target
0; an empty table gives no rows; a boundary document is taken if that brings the source nearer its target;
a text of any length counts whole; further columns are kept by ``mix``, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, scratch, small, written, written_small

BITS, LEVELS = 12, 4
WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """(source, source_size) -> with target, copies, rest. Its windows run over one row per source."""
    every = Window.partitionBy()
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = reduce(
        lambda other, i: F.when(F.pmod(F.col("at"), F.lit(len(weights))) == i, F.lit(float(weights[i]))).otherwise(other),
        range(1, len(weights)),
        F.lit(float(weights[0])),
    )
    t = sizes.withColumn("at", F.row_number().over(ordered) - 1).withColumn("weight", weight)
    t = t.withColumn("cap", (F.col("source_size") * max_repeats).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "at").rowsBetween(Window.unboundedPreceding, -1)
    free = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    budget = F.sum("source_size").over(every).cast("double") * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    t = t.withColumn("level", budget / free)
    level = F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(every)
    t = t.withColumn("target", F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap"))))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    t = t.withColumn("copies", copies)
    return t.select("source", "source_size", "target", "copies", (F.col("target") - F.col("copies") * F.col("source_size")).alias("rest"))


def edges(sized: DataFrame, open_: DataFrame, key: str) -> DataFrame:
    """(source, rest, edge, base, to, n), marked for broadcast if small: of each open source (source, rest) the key at which the running size passes the rest, the size before and with it, and its rows."""
    state = open_.select("source", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("base"))
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        state = (small(state) if level == 1 else state).alias("s")
        inside = sized.alias("d").join(
            state,
            F.col("d.source").eqNullSafe(F.col("s.source")) & (F.shiftright(F.col(f"d.{key}"), shift + BITS) == F.col("s.prefix")),
        )
        histogram = inside.groupBy(F.col("s.source").alias("source"), F.shiftright(F.col(f"d.{key}"), shift).alias("bucket")).agg(
            F.sum("d.size").alias("tokens"), F.first("s.rest").alias("rest"), F.first("s.base").alias("base"), F.count("*").alias("n")
        )
        running = Window.partitionBy("source").orderBy("bucket")
        histogram = histogram.withColumn("to", F.col("base") + F.sum("tokens").over(running))
        boundary = F.min(F.when(F.col("to") > F.col("rest"), F.struct("bucket", "to", "tokens", "rest", "n")))
        state = written_small(histogram.groupBy("source").agg(boundary.alias("b")).where("b is not null").select(
            "source", F.col("b.rest").alias("rest"), F.col("b.bucket").alias("prefix"),
            (F.col("b.to") - F.col("b.tokens")).alias("base"), F.col("b.to").alias("to"), F.col("b.n").alias("n"),
        ))
    return state.withColumnRenamed("prefix", "edge")


def whole_edge() -> Column:
    """Whether taking the edge brings a source nearer its target than leaving it."""
    return (F.col("to") - F.col("rest")) < (F.col("rest") - F.col("base"))


def hash_of(doc_id: Column) -> Column:
    """48 bits by which documents of a source are ordered; other languages have this hash too."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS * LEVELS // 4), 16, 10).cast("long")


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def drawn() -> Column:
    """A number of as many bits for each row; only of use once it is written."""
    return F.floor(F.rand() * float(1 << (BITS * LEVELS))).cast("long")


def content_of(docs: DataFrame) -> Column:
    """A hash of a row's columns, of those that can be hashed."""
    plain = [f.name for f in docs.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), 64 - BITS * LEVELS)


def at_edge(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The rows at the edges of several rows."""
    several = found.where("n > 1").select(F.col("source").alias("_source"), F.col("edge").alias("_edge"))
    return rows.join(several, F.col("source").eqNullSafe(F.col("_source")) & (F.col(key) == F.col("_edge"))).drop("_source", "_edge")


def _left(found: DataFrame) -> DataFrame:
    """What is left to take at the edges of several rows."""
    return found.where("n > 1").select("source", (F.col("rest") - F.col("base")).alias("rest"))


def source_plan(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, max_repeats: int = 2, keys: tuple[str, ...] = ("h", "g", "t")) -> tuple[DataFrame, DataFrame | None]:
    """(source, source_size, target, copies, and for each key its edge and whether that is taken whole), a row per source, written; and the last edges if they are still of several rows.

    ``sized``: source, size and the keys, each of which parts rows that those before it leave together.
    """
    targets = written(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeats))
    out, rows, open_, found = targets.drop("rest"), sized, targets.select("source", "rest"), None
    for i, key in enumerate(keys):
        if i and (found is None or found.where("n > 1").isEmpty()):
            found = None
            out = out.withColumns({f"edge_{key}": F.lit(None).cast("long"), f"whole_{key}": F.lit(None).cast("boolean")})
            continue
        if i:
            rows, open_ = at_edge(rows, found, keys[i - 1]), _left(found)
        found = edges(rows, open_, key)
        known = found.select("source", F.col("edge").alias(f"edge_{key}"), whole_edge().alias(f"whole_{key}")).alias("b")
        out = out.alias("a").join(known, F.col("a.source").eqNullSafe(F.col("b.source")), "left").select("a.*", f"b.edge_{key}", f"b.whole_{key}")
    return written_small(out), found if found is not None and not found.where("n > 1").isEmpty() else None


def times_taken(row: str, keys: tuple[str, ...] = ("h", "g", "t")) -> Column:
    """How often the plan ``p`` takes a row whose keys are columns of ``row``."""
    below = F.lit(False)
    for key in reversed(keys):
        own, edge = F.col(f"{row}.{key}"), F.col(f"p.edge_{key}")
        here = F.col(f"p.whole_{key}") if key == keys[-1] else F.when(F.col(f"p.edge_{keys[keys.index(key) + 1]}").isNull(), F.col(f"p.whole_{key}")).otherwise(below)
        below = (own < edge) | ((own == edge) & here)
    return F.col("p.copies") + F.coalesce(below.cast("long"), F.lit(0))


def mix_plan(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """One row per document: doc_id, source, size, h, source_size, target, times."""
    content = F.shiftrightunsigned(F.xxhash64("text"), 64 - BITS * LEVELS)
    sized = written(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), hash_of(F.col("doc_id")).alias("h"), content.alias("g"), drawn().alias("t")))
    per_source, _ = source_plan(sized, weights, share, max_repeats)
    return sized.alias("d").join(per_source.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).select(
        "d.doc_id", "d.source", "d.size", "d.h", "source_size", "target", times_taken("d").alias("times")
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the plan takes it, all columns kept.

    Sizes and hashes are written once for the histograms; the documents themselves are only filtered, each by the hashes of its
    own id and contents against the edges of its source, and joined to nothing but the table of sources. Only equal rows at an edge, where there are any, are written again,
    with the numbers that tell them apart.
    """
    keys = ("h", "g")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col("source"), size_of(F.col("text")).alias("size"), hash_of(F.col("doc_id")).alias("h"), content_of(docs).alias("g"))
    equal = None
    with scratch(docs.sparkSession):
        sized = written(keyed.drop("row"))
        plan, several = source_plan(sized, weights, share, max_repeats, keys)
        per_source = written_small(plan, keep=True)
        if several is not None:
            only = per_source.join(several.where("n > 1").select(F.col("source").alias("_s"), F.col("edge").alias("_e")), F.col("source").eqNullSafe(F.col("_s")) & (F.col("edge_g") == F.col("_e")))
            only = written_small(only.select(F.col("source").alias("_source"), "edge_h", "edge_g", "copies"), keep=True)
            at = F.col("source").eqNullSafe(F.col("_source")) & (F.col("h") == F.col("edge_h")) & (F.col("g") == F.col("edge_g"))
            equal = written(keyed.join(only, at).select("row", "source", "size", "copies", drawn().alias("t")), keep=True)
            last = edges(equal, _left(several), "t")
            found = written_small(last.select(F.col("source").alias("_source"), F.col("edge").alias("_edge"), whole_edge().alias("_whole")), keep=True)
    joined = keyed.alias("d").join(per_source.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    rows = joined.select("d.row", F.col("d.source").alias("source"), F.col("d.h").alias("h"), F.col("d.g").alias("g"), times_taken("d", keys).alias("times"))
    if equal is not None:
        rows = rows.join(only, at, "left_anti").select("row", "times")
        more = (F.col("t") < F.col("_edge")) | ((F.col("t") == F.col("_edge")) & F.col("_whole"))
        rest = equal.join(found, F.col("source").eqNullSafe(F.col("_source")), "left").select("row", (F.col("copies") + F.coalesce(more.cast("long"), F.lit(0))).alias("times"))
        rows = rows.unionByName(rest)
    return rows.where("times > 0").select(F.explode(F.array_repeat("row", F.col("times").cast("int"))).alias("row")).select("row.*")
