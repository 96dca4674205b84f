"""N-gram Jaccard join by a token-group matrix; exact at its threshold, and without all pairs.

A document is the set of its word shingles, hashed to 64 bits. Two documents link when the Jaccard
similarity of their sets reaches ``percent``.

Which documents can link. Two sets that link differ in at most d tokens, and d follows from their
sizes. Cut the hash range into more than d parts: all but d must be equal in both, so documents are dealt
by the digests of their d + 1 largest parts. Sizes are cut into classes such that linked sets are in one
class or in neighbouring ones, and a document is dealt by the parts of its own class and of the one below.
A common passage fills parts only in part, so frequent shingles draw no one together.

Groups. The documents of equal parts form groups: each goes to the least document that it shares a
part with, and groups are cut into blocks of about ``BLOCK``. A block's matrix has a row for each
member and a column for each token of the block's union. A query's tokens are first looked up in the
union, which bounds its overlap with every member; only blocks that could reach the threshold are
opened, and then one sum over the query's columns gives its overlap with all members.

Every document first queries the first block of each group it met. The links found join documents to
components, and these are put in one order, by size, that all later rounds keep. The further blocks of
large groups are then queried only by documents that come before a member which they are not yet connected
to. Of two documents still apart the one that comes first always queries the other's block, and pairs
already connected are left out, so components stay exact. This is done for a few blocks, then for sixteen
times as many, and so on, as most documents find their component early.

Skew. Equal sets are one node, so a text of which there are many copies is dealt once; documents of a batch that share
a part are tied to one of them before the shuffle; the rows of a part are streamed in sorted order, never gathered; a
block that many ask is replicated; a query's tokens are held one document at a time and a block's are
bounded. Defined results: null or empty texts have an empty set and link to nothing; rows with a null
id are their own row with a null component; rows with one id are one node; repeated rows get a row each; an empty
table gives no rows; a text of any length is hashed whole, in blocks; columns but ``doc_id`` and ``text`` are not read.
Ids that are no integers are refused.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, scratch, small, written, written_small
from .components import components
from .wordhash import byte_rows, mix, shingle_hashes, word_hashes

BLOCK = 64
#: Distinct sets that a task remembers in order to deal equal ones once.
REMEMBERED = 200_000
#: Ids (two longs at most) up to which a list of documents may be broadcast; beyond it the join shuffles.
BROADCAST_IDS = 500_000
#: Queries of a block that go to one task; a block with more is replicated.
ASKERS = 200


def size_classes(percent: int, up_to: int) -> np.ndarray:
    """Least size of each class: the sizes that can link to one of a class are in it or the next."""
    least = [1]
    while least[-1] <= up_to:
        least.append(max(least[-1] + 1, math.ceil(Fraction(100 * least[-1], percent))))
    return np.array(least)


def most_apart(size: int, percent: int) -> int:
    """Most tokens in which a set of this size differs from one that it links to."""
    return size * (100 - percent) // percent


def parts_of(level_least: np.ndarray, level: int, percent: int) -> int:
    """Parts of a size class: three tenths more than the tokens that its sets may differ in, plus one."""
    least = most_apart(int(level_least[level + 1]) - 1, percent) + 1
    return least + 3 * least // 10


def part_digests(tokens: np.ndarray, percent: int, level_least: np.ndarray) -> np.ndarray:
    """The digests by which a sorted set is dealt, for its own size class and for the class below.

    Of two sets that differ in d tokens at most d parts differ. Taken in one order of contents, largest parts
    first, the first d + 1 parts of both therefore have one in common: the others, small or empty ones that
    many sets share, are not dealt.
    """
    n = len(tokens)
    own = int(np.searchsorted(level_least, n, side="right")) - 1
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(tokens))))
    out = []
    for level in (own, own - 1):
        if level < 0:
            continue
        k = parts_of(level_least, level, percent)
        step = np.uint64(((1 << 64) - 1) // k)
        cuts = np.searchsorted(tokens, np.arange(1, k, dtype=np.uint64) * step)
        at = np.concatenate(([0], cuts, [n]))
        size = at[1:] - at[:-1]
        digest = mix(sums[at[1:]] - sums[at[:-1]] + mix(np.arange(k, dtype=np.uint64) + np.uint64(level << 32)) + size.astype(np.uint64))
        first = min(most_apart(n, percent), most_apart(int(level_least[level + 1]) - 1, percent)) + 1
        out.append(digest[np.lexsort((digest, -size))[:first]] if first < k else digest)
    return np.concatenate(out)


def shingle_set(data: np.ndarray | None, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(data, lower=True), words)) if data is not None else np.empty(0, np.uint64)


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    a, b = mix(tokens).sum(dtype=np.uint64), mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _sizes(words: int):
    """(doc_id, text_hash, text) -> (doc_id, text_hash, n, hi, lo): the size and digest of every set."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [shingle_set(data, words) for data in byte_rows(batch.column(2))]
            n, hi, lo = np.array([(len(s), *_digest(s)) for s in sets], dtype=np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(hi), pa.array(lo)], names=["doc_id", "text_hash", "n", "hi", "lo"])

    return run


def _parts(words: int, percent: int):
    """(doc_id, text) -> (part, doc_id, tied), one row per part of a set that is new to the task.

    Of documents of a batch that share a part only the least (tied is null) goes on to meet those of other batches;
    the rest are tied to it, so a part that a third of all documents have is one row a batch.
    """

    def run(batches):
        import pyarrow as pa

        seen: set[tuple[int, int]] = set()
        least = size_classes(percent, 1 << 14)
        for batch in batches:
            ids, dealt = batch.column(0).to_numpy(), []
            for i, data in enumerate(byte_rows(batch.column(1))):
                tokens = shingle_set(data, words)
                digest = _digest(tokens)
                if not len(tokens) or digest in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(digest)
                if len(tokens) >= least[-1]:
                    least = size_classes(percent, 2 * len(tokens))
                dealt.append((i, part_digests(tokens, percent, least)))
            if not dealt:
                continue
            part = np.concatenate([p for _, p in dealt]).view(np.int64)
            doc = np.repeat(ids[[i for i, _ in dealt]], [len(p) for _, p in dealt])
            order = np.lexsort((doc, part))
            part, doc = part[order], doc[order]
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            head = np.repeat(doc[first], np.diff(np.append(first, len(part))))
            new = np.concatenate(([True], (part[1:] != part[:-1]) | (doc[1:] != doc[:-1])))
            tied = pa.array(head[new], mask=(head == doc)[new])
            yield pa.RecordBatch.from_arrays([pa.array(part[new]), pa.array(doc[new]), tied], names=["part", "doc_id", "tied"])

    return run


def _met(batches):
    """Sorted (part, doc_id, tied) -> (part, doc_id, head, tied) for parts with more documents than one, head being the least; streamed.

    Rows tied within their batch pass unchanged, with the document that they are tied to as their head.
    """
    import pyarrow as pa

    def out(part, doc, head, tied: bool):
        return pa.RecordBatch.from_arrays([pa.array(part), pa.array(doc), pa.array(head), pa.array(np.full(len(part), tied))], names=["part", "doc_id", "head", "tied"])

    held_part, held_head, shown = None, None, False  # the part of the last row, its least document, and whether that was sent
    for batch in batches:
        bound = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        part, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if bound.any():
            yield out(part[bound], doc[bound], batch.column(2).filter(pa.array(bound)).to_numpy(), True)
            part, doc = part[~bound], doc[~bound]
        if not len(part):
            continue
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        sizes = np.diff(np.append(first, len(part)))
        heads, sent = doc[first].copy(), np.zeros(len(first), dtype=bool)
        if part[0] == held_part:  # the first run goes on from the batch before
            heads[0], sent[0] = held_head, shown
        head = np.repeat(heads, sizes)
        other = doc != head
        met = np.logical_or.reduceat(other, first)  # runs in which someone meets the head
        now = met & ~sent
        yield out(np.concatenate([part[other], part[first[now]]]), np.concatenate([doc[other], heads[now]]), np.concatenate([head[other], heads[now]]), False)
        held_part, held_head, shown = part[-1], heads[-1], bool(met[-1] or sent[-1])


def _tokens(words: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [shingle_set(data, words).tobytes() for data in byte_rows(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "tokens"])

    return run


def needed(size: int, percent: int) -> int:
    """Least overlap with any set that a set of this size can link to."""
    return -(-size * percent // 100)


class Matrix:
    """The members of a block by the tokens of their union."""

    def __init__(self, ids: list[int], sets: list[np.ndarray]) -> None:
        self.ids, self.sizes = np.array(ids), np.array([len(s) for s in sets])
        self.union = np.unique(np.concatenate(sets))
        self.rows = np.zeros((len(self.union), len(sets)), dtype=bool)
        for j, s in enumerate(sets):
            self.rows[np.searchsorted(self.union, s), j] = True

    def links(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Members that link to the query; the block is opened only if its union could reach them."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        columns = at[self.union[at] == query]
        if len(columns) < needed(len(query), percent):
            return self.ids[:0]
        overlap = self.rows[columns].sum(axis=0)
        return self.ids[100 * overlap >= percent * (self.sizes + len(query) - overlap)]


def _links(percent: int):
    """Rows (head, block, query, doc_id, tokens, copy), members before queries, sorted by copy of a block -> links (a, b)."""

    def run(batches):
        import pyarrow as pa

        key, ids, sets, matrix = None, [], [], None
        for batch in batches:
            a, b = [], []
            heads, blocks_, query, doc, copies = (batch.column(k).to_pylist() for k in (0, 1, 2, 3, 5))
            for i in range(len(doc)):
                if (heads[i], blocks_[i], copies[i]) != key:
                    key, ids, sets, matrix = (heads[i], blocks_[i], copies[i]), [], [], None
                tokens = np.frombuffer(batch.column(4)[i].as_buffer(), dtype=np.uint64)
                if not query[i]:
                    ids.append(doc[i])
                    sets.append(tokens.copy())
                elif ids:
                    matrix = matrix or Matrix(ids, sets)
                    for other in matrix.links(tokens, percent):
                        if other != doc[i]:
                            a.append(doc[i])
                            b.append(int(other))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``. ``doc_id`` must be an integer."""
    with scratch(docs.sparkSession):
        return written(_components(docs, words, percent), keep=True)


def _components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    sizes = written(mapped(texts, _sizes(words), "doc_id bigint, text_hash bigint, n bigint, hi bigint, lo bigint"))
    # equal sets are one node, the least id's; the others are not dealt
    equal = sizes.where("n > 0 and doc_id is not null").groupBy("n", "hi", "lo").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    equal = written_small(equal.where("copies > 1").drop("copies"))
    nodes = written(sizes.join(equal, ["n", "hi", "lo"], "left").select("doc_id", "text_hash", "n", "first"))
    copies = written_small(nodes.where("first <> doc_id").select("doc_id", "text_hash").distinct(), BROADCAST_IDS)
    own = texts.where("doc_id is not null").join(copies, ["doc_id", "text_hash"], "left_anti").select("doc_id", "text")
    dealt = mapped(own, _parts(words, percent), "part bigint, doc_id bigint, tied bigint")
    # rows that are tied already are spread, as nothing of a part has to meet there
    dealt = dealt.repartition("part", F.when(F.col("tied").isNull(), F.lit(-1)).otherwise(F.pmod("doc_id", F.lit(64)))).sortWithinPartitions("part", "doc_id")
    met = written(mapped(dealt, _met, "part bigint, doc_id bigint, head bigint, tied boolean"))
    free, tied = met.where("not tied").drop("tied"), met.where("tied").alias("t")
    at = tied.join(free.alias("f"), (F.col("t.part") == F.col("f.part")) & (F.col("t.head") == F.col("f.doc_id")), "left")
    at = at.select("t.part", F.col("t.doc_id").alias("doc_id"), F.col("t.head").alias("near"), F.coalesce("f.head", "t.head").alias("head"))
    heads = at.where("near = head").select("part", F.col("near").alias("doc_id"), "head").distinct()
    met = written(free.unionByName(at.drop("near")).unionByName(heads))
    # a document's group is the least head it met; groups beyond BLOCK are cut by hash
    home = written(met.groupBy("doc_id").agg(F.min("head").alias("home")))
    count = written_small(home.groupBy("home").count().where(F.col("count") > BLOCK))
    block = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("count") / BLOCK)), F.lit(0)).cast("int")
    home = written(home.join(count, "home", "left").select("doc_id", "home", block.alias("block")))
    grouped = own.join(small(home.select("doc_id"), BROADCAST_IDS), "doc_id", "left_semi")
    tokens = written(mapped(grouped, _tokens(words), "doc_id bigint, tokens binary"))
    members = met.select("part", "doc_id").join(home.select("doc_id", "home"), "doc_id")
    groups = members.select("part", "home").distinct()
    asked = written(members.select("part", "doc_id").join(groups, "part").select("doc_id", "home").distinct())

    def verified(queries: DataFrame) -> DataFrame:
        """Links of the queries (doc_id, home, block) to members of their blocks; a block of many queries is replicated for each ``ASKERS`` of them."""
        asking = written(queries.groupBy("home", "block").agg(F.ceil(F.count("*") / ASKERS).cast("int").alias("copies")))
        many = written_small(asking.where("copies > 1"))
        copy = F.pmod(F.xxhash64("doc_id"), F.coalesce("copies", F.lit(1))).cast("int")
        spread = queries.join(many, ["home", "block"], "left").select("doc_id", "home", "block", copy.alias("copy"), F.lit(1).alias("query"))
        members = home.join(asking, ["home", "block"]).select("doc_id", "home", "block", F.explode(F.expr("sequence(0, copies - 1)")).alias("copy"), F.lit(0).alias("query"))
        full = members.unionByName(spread).join(tokens, "doc_id").select("home", "block", "query", "doc_id", "tokens", "copy")
        sorted_ = full.repartition("home", "block", "copy").sortWithinPartitions("home", "block", "copy", "query")
        return mapped(sorted_, _links(percent), "a bigint, b bigint")

    def two_greatest(placed: DataFrame, *of: str) -> DataFrame:
        """(of..., first, second): the greatest order of all and the greatest of another component, of each group."""
        one = placed.groupBy(*of, "component").agg(F.max("order").alias("order"))
        place = F.row_number().over(Window.partitionBy(*of).orderBy(F.col("order").desc(), F.col("component").desc()))
        top = one.withColumn("place", place).where("place <= 2").groupBy(*of).agg(F.array_sort(F.collect_list(F.struct("place", "order", "component"))).alias("top"))
        return top.select(*of, F.col("top")[0].alias("first"), F.try_element_at("top", F.lit(2))["order"].alias("second"))

    def comes_before(top: str) -> Column:
        """Whether a query comes before the greatest that it is not connected to."""
        return F.col("q.order") < F.when(F.col(f"{top}.first.component") == F.col("q.component"), F.col(f"{top}.second")).otherwise(F.col(f"{top}.first.order"))

    links = written(verified(asked.withColumn("block", F.lit(0))))
    last = home.agg(F.max("block")).first()[0] or 0
    begin, width, ranked = 1, 4, None
    while begin <= last:
        of = components(links).withColumnRenamed("node", "doc_id")
        if ranked is None:
            # components of the first blocks in order of size, one order for all rounds: of two documents apart, the lesser queries the other's block
            found = home.join(of, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
            order = found.groupBy("component").count().select("component", F.struct("count", "component").alias("order"))
            ranked = written(found.join(order, "component").select("doc_id", "home", "block", "order"))
            placed = ranked.withColumn("component", F.col("order.component"))
        else:
            placed = written(ranked.join(of, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")))
        opened = placed.where(F.col("block").between(begin, begin + width - 1))
        asking = asked.join(placed.select("doc_id", "order", "component"), "doc_id").alias("q")
        # first by what a group as a whole has to offer, which leaves few queries where most are connected; then block by block
        groups_ = written_small(two_greatest(opened, "home")).alias("g")
        some = written(asking.join(groups_, (F.col("q.home") == F.col("g.home")) & comes_before("g")).select("q.*")).alias("q")
        queries = some.join(written_small(two_greatest(opened, "home", "block")).alias("o"), (F.col("q.home") == F.col("o.home")) & comes_before("o"))
        links = written(links.unionByName(verified(written(queries.select("q.doc_id", "q.home", "o.block")))))
        begin, width = begin + width, width * 16
    edges = links.select("a", "b").union(nodes.where("first <> doc_id").select("first", "doc_id"))
    found = components(edges)
    return nodes.join(found, nodes.doc_id == found.node, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def first_of_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document, the least id, of each component; documents without words and null ids stay.

    Rows that share the least id all stay, equal ones too; all columns are kept, whatever their names; texts count whole; an empty table gives no rows.
    """
    columns = docs.columns
    others = written_small(jaccard_components(docs, words, percent).where("component_id <> doc_id").select("doc_id").distinct())
    return docs.join(others, "doc_id", "left_anti").select(*columns)
