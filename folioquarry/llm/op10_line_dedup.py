"""Line dedup: repeated runs of lines, found by prefix doubling over line-ID sequences.

A text is the sequence of its lines that hold a word. Suffixes of these sequences are ordered by
distributed prefix doubling: their rank by the first line comes from the lines' hashes, and the rank
by 2h lines from the pair (rank of the first h, rank of the h that follow); pairs are counted before
they shuffle, sorted by range and numbered. Suffixes whose pair is unique leave. The common-prefix
interval of a run of n lines, 2**k <= n < 2**(k+1), is the set of places with equal ranks (rank_k at its
start, rank_k at its end - 2**k).

A repeated run counts if it has ``min_words`` words. Every maximal such run is the union of its
shortest qualifying pieces, taken forwards and backwards from each line, so only the intervals of these
pieces are looked at, and doubling ends at the longest piece: its depth depends on ``min_words``, not
on how long copies are. The first place of each interval (by id, then line) stays; the lines of later
places are deleted, except lines that the first place itself covers.

No key is ever gathered: intervals are reduced to a minimum, and joins on ranks are ones that Spark
splits where skewed. A document is worked as one row, as its text is.

Defined results: a null text stays null; null ids come last in order; rows equal in id and text are one
document in several rows, and are edited alike; blank lines between deleted lines go with them; a text
whose lines are all deleted becomes empty; an empty table gives no rows; a text of any length is edited whole;
further columns are kept, whatever their names, but ``removed_lines`` is replaced. Lines are told apart by a
64-bit hash and their length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, scratch, written, written_small
from .wordhash import SEPARATOR, blocks, byte_rows, runs, span_hashes

MIN_WORDS = 50
NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[10] = True
KEY = ("doc_id", "text_hash")


def line_facts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each line with a word: its number, hash, bytes and words."""
    out, seen = [], 0
    for part in blocks(data, NEWLINE):
        if not len(part):
            continue
        breaks = np.flatnonzero(part == 10)
        starts, ends = np.concatenate(([0], breaks + 1)), np.append(breaks, len(part))
        solid = ~SEPARATOR[part]
        begins = np.concatenate(([0], np.cumsum(solid & ~np.concatenate(([False], solid[:-1])))))
        words = begins[ends] - begins[starts]
        some = np.flatnonzero(words)
        out.append((some + seen, span_hashes(part, starts[some], ends[some]), (ends - starts)[some], words[some]))
        seen += len(breaks)
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _lines(batches):
    import pyarrow as pa

    for batch in batches:
        texts = byte_rows(batch.column(2))
        facts = [line_facts(t) if t is not None else tuple(np.empty(0, np.int64) for _ in range(4)) for t in texts]
        n = np.array([len(f[0]) for f in facts], dtype=np.int64)
        owner = pa.array(np.repeat(np.arange(len(facts)), n))
        parts = [np.concatenate([f[k] for f in facts]) if facts else np.empty(0) for k in range(4)]
        seq = np.concatenate([np.arange(k) for k in n]) if len(n) else np.empty(0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(seq.astype(np.int32)), pa.array(parts[0].astype(np.int32)),
             pa.array(parts[1].astype(np.uint64).view(np.int64)), pa.array(parts[2].astype(np.int64)), pa.array(parts[3].astype(np.int32))],
            names=["doc_id", "text_hash", "seq", "line_no", "hash", "bytes", "words"],
        )


def pieces(seq: list[int], words: list[int], least: int) -> set[tuple[int, int]]:
    """(first, length) of the shortest pieces of consecutive lines with ``least`` words that start, or end, at each line."""
    found: set[tuple[int, int]] = set()
    start, total = 0, 0
    for end in range(len(seq)):  # ending at each line: drop leading lines while enough remain
        if end and seq[end] != seq[end - 1] + 1:
            start, total = end, 0
        total += words[end]
        while total - words[start] >= least:
            total -= words[start]
            start += 1
        if total >= least:
            found.add((start, end - start + 1))
    end, total = len(seq) - 1, 0
    for start in range(len(seq) - 1, -1, -1):  # starting at each line
        if start + 1 < len(seq) and seq[start] != seq[start + 1] - 1:
            end, total = start, 0
        total += words[start]
        while total - words[end] >= least:
            total -= words[end]
            end -= 1
        if total >= least:
            found.add((start, end - start + 1))
    return found


def _pieces(least: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("at", "kind", "seq", "first", "n", "to", "rank")}
            for at, lines in enumerate(batch.column(2).to_pylist()):
                seq, no = [x["seq"] for x in lines], [x["line_no"] for x in lines]
                deep = set()
                for start, n in pieces(seq, [x["words"] for x in lines], least):
                    for k, v in (("at", at), ("kind", 1), ("seq", seq[start]), ("first", no[start]), ("n", n), ("to", no[start + n - 1] + 1), ("rank", lines[start]["rank"])):
                        rows[k].append(v)
                    if n > 1:
                        deep.update(range(start, start + n))
                for i in deep:
                    for k, v in (("at", at), ("kind", 0), ("seq", seq[i]), ("first", 0), ("n", 0), ("to", 0), ("rank", lines[i]["rank"])):
                        rows[k].append(v)
            owner = pa.array(rows["at"], pa.int32())
            ints = [pa.array(rows[k], pa.int32()) for k in ("kind", "seq", "first", "n", "to")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(1).take(owner), *ints, pa.array(rows["rank"], pa.int64())],
                names=["doc_id", "text_hash", "kind", "seq", "first", "n", "to", "rank"],
            )

    return run


def ranked(df: DataFrame, *by: str) -> DataFrame:
    """``df`` (distinct in ``by``) with ``rank``, its place in the order of ``by``: sorted by range, numbered within ranges."""
    dealt = written(df.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()))
    sizes = {r["_range"]: r["count"] for r in dealt.groupBy("_range").count().collect()}  # a row per range, not per key
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    start = F.element_at(F.array(*map(F.lit, before)), F.col("_range") + 1) if before else F.lit(0)
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*by))
    return dealt.withColumn("rank", (start + inside).cast("bigint")).drop("_range")


def same(a: str, b: str, *names: str) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}"))
    return out


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, starts, ends): line ranges to delete, for documents that have any."""
    kind = dict(docs.dtypes)["doc_id"]
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    lines = written(mapped(keyed, _lines, f"doc_id {kind}, text_hash bigint, seq int, line_no int, hash bigint, bytes bigint, words int"))
    repeated = lines.groupBy("hash", "bytes").count().where("count > 1").drop("count")
    named = lines.join(ranked(repeated, "hash", "bytes"), ["hash", "bytes"])
    line = F.struct("seq", "line_no", "rank", "words")
    sequences = named.groupBy(*KEY).agg(F.array_sort(F.collect_set(line)).alias("lines"))
    found = written(mapped(sequences, _pieces(min_words), f"doc_id {kind}, text_hash bigint, kind int, seq int, first int, n int, to int, rank bigint"))
    whole = found.where("kind = 1")
    longest = whole.agg(F.max("n")).first()[0] or 1
    place = whole.where("n = 1").select(*KEY, "seq", "first", "n", "to", F.col("rank").alias("a"), F.col("rank").alias("b"))
    level = found.where("kind = 0").select(*KEY, "seq", "rank")
    k = 1
    while 2**k <= longest:
        half = 2 ** (k - 1)
        pairs = level.alias("x").join(level.alias("y"), same("x", "y", *KEY) & (F.col("y.seq") == F.col("x.seq") + half)).select(
            *[f"x.{c}" for c in KEY], "x.seq", F.col("x.rank").alias("a"), F.col("y.rank").alias("b")
        )
        twice = pairs.groupBy("a", "b").count().where("count > 1").drop("count")
        level = written(pairs.join(ranked(twice, "a", "b"), ["a", "b"]).select(*KEY, "seq", "rank"))
        of_level = whole.where((F.col("n") >= 2**k) & (F.col("n") < 2 ** (k + 1))).alias("w")
        both = of_level.join(level.alias("x"), same("w", "x", *KEY) & (F.col("x.seq") == F.col("w.seq"))).join(
            level.alias("y"), same("w", "y", *KEY) & (F.col("y.seq") == F.col("w.seq") + F.col("w.n") - 2**k)
        )
        # each level is written by itself: one query over all levels would be a plan that grows with them, planned anew whenever one of its stages ends
        place = place.unionByName(written(both.select("w.doc_id", "w.text_hash", "w.seq", "w.first", "w.n", "w.to", F.col("x.rank").alias("a"), F.col("y.rank").alias("b"))))
        k += 1
    at = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "seq", "to")
    interval = place.groupBy("n", "a", "b").agg(F.min(at).alias("head"), F.count("*").alias("places")).where("places > 1")
    # written, so that the join deals both sides anew and a hot interval's places can be split
    interval = written_small(interval)
    later = place.alias("p").join(interval.alias("i"), ["n", "a", "b"]).where(at != F.col("head"))
    here = F.col("p.doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("p.text_hash") == F.col("head.text_hash"))
    start = F.when(here, F.greatest(F.col("first"), F.col("head.to"))).otherwise(F.col("first"))
    cut = later.select("p.doc_id", "p.text_hash", start.alias("start"), F.col("to").alias("end")).where("start < end")
    return cut.groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("cuts")).select(
        *KEY, F.col("cuts.start").alias("starts"), F.col("cuts.end").alias("ends")
    )


def without_ranges(text: str, starts: np.ndarray, ends: np.ndarray) -> tuple[str, int]:
    """A text without some ranges of its lines, and how many of these held a word."""
    lines = text.split("\n")
    step = np.zeros(len(lines) + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    gone = np.cumsum(step[:-1]) > 0
    removed = sum(1 for x, g in zip(lines, gone, strict=True) if g and not all(c in " \t\n\v\f\r" for c in x))
    return "\n".join(x for x, g in zip(lines, gone, strict=True) if not g), removed


def _edited(at: int):
    """(row, starts, ends) -> the row's columns with the text (column ``at``) edited, and the lines removed."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            row = batch.column(0)
            columns = row.flatten()
            done = [without_ranges(t, np.asarray(a), np.asarray(b)) for t, a, b in zip(columns[at].to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns[at] = pa.array([d[0] for d in done], columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array([d[1] for d in done], pa.int64())], names=[*(f.name for f in row.type), "removed_lines"])

    return run


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``; ``removed_lines`` has their number."""
    with scratch(docs.sparkSession):
        cuts = written_small(deletions(docs, min_words), keep=True)
    columns = [c for c in docs.columns if c != "removed_lines"]
    # the row travels as one struct, so its columns cannot clash with the working ones
    keyed = docs.select(F.struct(*columns).alias("row"), F.xxhash64("text").alias("text_hash")).alias("d")
    on = F.col("d.row.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_hash") == F.col("c.text_hash"))
    kept = keyed.join(cuts.alias("c"), on, "left_anti").select("row.*", F.lit(0).cast("bigint").alias("removed_lines"))
    hit = keyed.join(cuts.alias("c"), on).select("d.row", "c.starts", "c.ends")
    return kept.unionByName(mapped(hit, _edited(columns.index("text")), kept.schema))
