"""Near duplicates by MinHash: one-permutation sketches, banded buckets, stars of candidates, links confirmed on full sets.

Sketch. The hashes of a document's shingles fall into ``BINS`` equal ranges, and the least hash of each is the bin's value: one pass over the
set in place of one for each permutation. An empty bin takes the value of the first bin that is not empty in an order of its own, the same
for all documents (optimal densification), so that sets of few shingles have sketches of equal bins as often as they are similar. Bands of ``ROWS`` bins are hashed to
buckets: two sets of similarity s share one of the ``BANDS`` buckets with probability 1 - (1 - s^5)^32, which is 0.999997 at 0.8.

Odd sketch. Each shingle flips one of ``BITS`` bits. In the difference of two such sketches the shingles in common cancel, so it has at most as many
bits as the sets differ in shingles: a pair with more than a link allows is none, without error, and for sets of a few hundred shingles little else is left.

Stars. All that share a bucket are candidates, but pairs are never listed. The members of least hash, eight expected, are the bucket's hubs; every other member is paired
with the first hub, in order of hash, that its sketches leave open: one pair a member and bucket at most. Open are pairs whose sketches agree in three fifths of the bins (five standard deviations or more below 0.8,
as simulated for sets of 5 to 1000 shingles), whose odd sketches and whose sizes could link. They are confirmed on their full sets.

The rest. Two members of a bucket may link though neither links to a hub. Buckets that hold documents of several components go on: their members are compared, by sketches held in a task, with the 4096 members of least
hash (expected) that they are not connected to, and, in larger buckets, with further ones, up to all; what is open is confirmed. So every two documents of a bucket are compared or connected, and
components are those of all candidate pairs. In a group of near copies most members find their component by the stars.

Skew. Equal sets are one node. Bucket members are counted, and hubs found, by aggregates that begin before the shuffle; the queries of a bucket
are dealt to several tasks, each with the hubs of the round, and so are the partners of one hub. Sets are held one at a time, except a hub's.

Defined results. Texts that are null or have no words have an empty set, link to nothing and are kept. Rows without an id have no component and are kept. Rows with one id are one node;
repeated rows get a row each. An empty table gives no rows. Texts of any length are hashed whole, in blocks. Ids that are no integers are refused.
Columns but ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, scratch, small, written
from .components import components
from .op02_jaccard import BROADCAST_IDS, _digest, _links, _tokens, shingle_set
from .wordhash import byte_rows, mix

ROWS, BANDS = 5, 32
BINS = ROWS * BANDS
#: Bits of the odd sketch.
BITS = 1024
WIDTH = BINS + BITS // 8
#: Bins in which the sketches of a pair must agree before its sets are compared.
AGREEING = 3 * BINS // 5
#: Expected hubs of a star; expected members of a bucket that are compared with all in the round after it, and how many times more in each further round.
STARS, HUBS, GROWTH = 8, 4096, 64
#: Members of a bucket, or partners of a hub, that go to one task.
ASKERS = 1000
PARTNERS = 200


@cache
def donors(bins: int = BINS) -> np.ndarray:
    """For each bin, the rank of every bin in the order in which it looks for a value; fixed for all documents and machines."""
    at = np.arange(bins, dtype=np.uint64)
    keys = mix(mix(at[:, None] + np.uint64(0x9E3779B97F4A7C15)) ^ mix(at[None] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)))
    return keys.argsort(axis=1).argsort(axis=1)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The least 32-bit hash of each bin of a sorted set that is not empty; empty bins take another's."""
    bins = ((tokens >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    there = bins[first].astype(np.int64)
    least = np.minimum.reduceat(tokens & np.uint64(0xFFFFFFFF), first)
    out = np.zeros(BINS, dtype=np.uint64)
    out[there] = least
    if len(there) < BINS:
        empty = np.setdiff1d(np.arange(BINS), there, assume_unique=True)
        out[empty] = least[donors()[np.ix_(empty, there)].argmin(axis=1)]
    return out


def buckets(values: np.ndarray) -> np.ndarray:
    """The bucket of each band of a sketch."""
    bands = values.reshape(BANDS, ROWS)
    h = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(ROWS))
    for i in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + bands[:, i])
    return h


def odd_sketch(tokens: np.ndarray) -> np.ndarray:
    """The parity of the shingles that fall to each bit, packed in bytes."""
    bits = mix(tokens ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(BITS)
    return np.packbits((np.bincount(bits.astype(np.int64), minlength=BITS) & 1).astype(np.uint8))


def open_pairs(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs may link, by their sketches (rows of ``WIDTH`` bytes) and sizes."""
    total = size_a + size_b
    apart = np.bitwise_count(a[..., BINS:] ^ b[..., BINS:]).sum(axis=-1, dtype=np.int64)
    agreeing = (a[..., :BINS] == b[..., :BINS]).sum(axis=-1)
    return (100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)) & (apart * (100 + percent) <= total * (100 - percent)) & (agreeing >= AGREEING)


def _sketches(words: int):
    """(doc_id, text_hash, text) -> size, digest, buckets, and the low bytes of the sketch with the odd sketch."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, hi, lo, bands, bytes_ = [], [], [], [], []
            for data in byte_rows(batch.column(2)):
                tokens = shingle_set(data, words)
                a, b = _digest(tokens)
                values = sketch(tokens) if len(tokens) else None
                n.append(len(tokens))
                hi.append(a)
                lo.append(b)
                bands.append(buckets(values).view(np.int64) if len(tokens) else None)
                bytes_.append(mix(values).astype(np.uint8).tobytes() + odd_sketch(tokens).tobytes() if len(tokens) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(bytes_, pa.binary())],
                names=["doc_id", "text_hash", "n", "hi", "lo", "buckets", "sketch"],
            )

    return run


def _bytes(column) -> np.ndarray:
    """Sketches as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, WIDTH)


def _compared(percent: int, first_only: bool):
    """Rows (bucket, copy, hub, doc_id, order, component, n, sketch) of a bucket's copy, hubs first, in order -> pairs still apart that the sketches leave open.

    A row is compared with the hubs that come before it in order, which have all been read by then; with ``first_only`` it is paired with the first open one.
    """

    def run(batches):
        import pyarrow as pa

        key, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)], axis=1)
            ids, order, component, n = (batch.column(k).to_numpy() for k in (3, 4, 5, 6))
            hub = batch.column(2).to_numpy(zero_copy_only=False)
            bytes_ = _bytes(batch.column(7))
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            a, b = [], []
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if key is None or (keys[lo] != key).any():
                    key, held = keys[lo].copy(), []
                for i in np.flatnonzero(hub[lo:hi]) + lo:
                    held.append((ids[i], order[i], component[i], n[i], bytes_[i].copy()))
                free = np.ones(hi - lo, dtype=bool)
                for one, first, of, size, low in held:
                    # every row that comes after the hub, and is not connected to it
                    later = (order[lo:hi] > first) | ((order[lo:hi] == first) & (ids[lo:hi] > one))
                    at = np.flatnonzero(free & later & (component[lo:hi] != of)) + lo
                    if len(at):
                        at = at[open_pairs(bytes_[at], low, n[at], size, percent)]
                        a.append(ids[at])
                        b.append(np.full(len(at), one))
                        if first_only:
                            free[at - lo] = False
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def _confirmed(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link by their full sets; b's set is held, a's pass by."""
    asking = written(pairs.groupBy(F.col("b").alias("head")).agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("copies")))
    copy = F.pmod(F.xxhash64("a"), F.coalesce("copies", F.lit(1))).cast("int")
    none, one = F.lit(0), F.lit(1)
    many = small(written(asking.where("copies > 1")))
    queries = pairs.withColumnRenamed("b", "head").join(many, "head", "left").select("head", none.alias("block"), one.alias("query"), F.col("a").alias("doc_id"), copy.alias("copy"))
    hubs = asking.select("head", none.alias("block"), none.alias("query"), F.col("head").alias("doc_id"), F.explode(F.expr("sequence(0, copies - 1)")).alias("copy"))
    full = hubs.unionByName(queries).join(tokens, "doc_id").select("head", "block", "query", "doc_id", "tokens", "copy")
    return mapped(full.repartition("head", "copy").sortWithinPartitions("head", "block", "copy", "query"), _links(percent), "a bigint, b bigint")


def _order(doc_id: str = "doc_id") -> Column:
    """A hash that orders documents alike in all buckets, from 0 up."""
    return F.shiftrightunsigned(F.xxhash64(doc_id), 1)


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of ``docs``. ``doc_id`` must be an integer."""
    with scratch(docs.sparkSession):
        return written(_near_duplicates(docs, words, percent), keep=True)


def _near_duplicates(docs: DataFrame, words: int, percent: int) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    sketches = written(mapped(texts, _sketches(words), "doc_id bigint, text_hash bigint, n bigint, hi bigint, lo bigint, buckets array<bigint>, sketch binary"))
    # equal sets are one node, the least id's
    sets = sketches.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "hi", "lo").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    sets = written(sets)
    first = small(written(sets.where("copies > 1").select("n", "hi", "lo", F.col("doc_id").alias("first"))))
    rows = written(sketches.drop("buckets", "sketch").join(first, ["n", "hi", "lo"], "left"))
    copies = small(rows.where("first <> doc_id").select("doc_id", "text_hash").distinct(), BROADCAST_IDS)
    node = sketches.where("n > 0 AND doc_id IS NOT NULL").join(copies, ["doc_id", "text_hash"], "left_anti")
    members = node.select(F.explode("buckets").alias("bucket"), "doc_id")
    several = members.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = written(members.join(several, "bucket"))
    own = node.select("doc_id", "n", "sketch")
    near = small(written(shared.select("doc_id").distinct()), BROADCAST_IDS)
    tokens = written(mapped(texts.join(copies, ["doc_id", "text_hash"], "left_anti").join(near, "doc_id", "left_semi").select("doc_id", "text"), _tokens(words), "doc_id bigint, tokens binary"))

    def open_(some: DataFrame, begin: int, end: int, first_only: bool) -> DataFrame:
        """Open pairs of rows (bucket, doc_id, members, component) with those of their bucket whose share of the order is from ``begin`` to ``end`` members."""
        share = F.col("order").cast("double") / float(1 << 63) * F.col("members")
        placed = some.withColumn("order", _order()).withColumn("share", share).where(F.col("share") >= begin).join(own, "doc_id")
        is_hub, tasks = F.col("share") < end, F.ceil(F.col("members") / ASKERS).cast("int")
        copy = F.explode(F.when(is_hub, F.sequence(F.lit(0), tasks - 1)).otherwise(F.array(F.pmod(F.xxhash64("doc_id"), tasks).cast("int"))))
        asking = placed.withColumns({"hub": is_hub, "copy": copy}).select("bucket", "copy", "hub", "doc_id", "order", "component", "n", "sketch")
        asking = asking.repartition("bucket", "copy").sortWithinPartitions("bucket", "copy", F.col("hub").desc(), "order", "doc_id")
        return written(mapped(asking, _compared(percent, first_only), "a bigint, b bigint").distinct())

    links = written(_confirmed(open_(shared.withColumn("component", F.col("doc_id")), 0, STARS, True), tokens, percent))
    most = shared.agg(F.max("members")).first()[0] or 0
    begin, end = 0, HUBS
    while begin < most:
        of = components(links).withColumnRenamed("node", "doc_id")
        placed = shared.join(of, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        apart = placed.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.any_value("members").alias("m"))
        # in smaller buckets all have met all others: two members in their star, and more in the rounds before
        apart = written(apart.where(F.col("a") != F.col("b")).where(F.col("m") > max(begin, min(STARS, 2))).select("bucket"))
        if apart.isEmpty():
            break
        links = written(links.unionByName(_confirmed(open_(placed.join(small(apart), "bucket"), begin, end, False), tokens, percent)))
        begin, end = end, end * GROWTH
    edges = links.select("a", "b").union(rows.where("first <> doc_id").select("first", "doc_id"))
    found = components(edges)
    out = rows.join(found, rows.doc_id == found.node, "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
