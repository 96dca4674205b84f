"""SimHash document fingerprints. DataFrame functions only.

Terms are runs of three words (a shorter text is one term). Each occurrence of a term votes with
the 64 bits of its hash: a set bit for, a clear bit against; the fingerprint has the bits that win.
Votes are counted 16 bits to a lane, four lanes to a long, so a term costs 16 additions in generated
code; a text is counted in runs of ``2 ** 14`` terms, so that even the highest lane, from bit 48, stays
below the sign (``2 ** 15`` votes there make ``2 ** 63``) however long the text is, and the runs' counts
are added as full longs.

``within`` finds all fingerprints within a Hamming radius by permuted block tables: the 64 bits are cut
into ``radius + spare`` blocks, and fingerprints that differ in at most ``radius`` bits agree on at
least ``spare`` whole blocks; each choice of ``spare`` blocks is a table keyed by those blocks.

Defined results: a null text counts as empty; an empty text has fingerprint 0; equal texts have
equal fingerprints; a bit with as many votes for as against is 0; rows with a null id have no neighbours and are their own
row in the result; repeated rows get a row each, rows of one id following each other by the hash of their texts; an
empty table gives no rows; texts of any length vote whole; columns but ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, written

LANES, PER_LONG, RUN_BITS = 16, 4, 14
ONES = 0x0001000100010001
SEPARATORS = r"[\x20\x09-\x0D]+"
#: Bytes of text that a range of ids should hold, and the most ranges; see ``next_document``.
RANGE_BYTES, MOST_RANGES = 8 << 20, 100_000
#: Query op4 searches the neighbours of every row whose id this divides.
SEARCHED = 100


def terms(text: Column) -> Column:
    """Array of structs of three consecutive words; a shorter text gives its words and nulls."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\f\r"))  # so that no piece of the split is empty
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SEPARATORS))
    n = F.greatest(F.size(words) - 2, F.least(F.size(words), F.lit(1)))
    return F.arrays_zip(F.slice(words, 1, n), F.slice(words, 2, n), F.slice(words, 3, n))


def fingerprints(df: DataFrame, key: list[str], text: str, out: str) -> DataFrame:
    """(key..., out): one row per distinct key."""
    exploded = df.select(*key, F.posexplode_outer(terms(F.col(text))).alias("pos", "t"))
    # votes of nothing for the row that an empty text keeps
    hashed = exploded.select(*key, F.shiftright("pos", RUN_BITS).alias("run"), F.when(F.col("t").isNotNull(), F.xxhash64("t")).alias("h"))
    lanes = [F.sum(F.shiftright("h", i).bitwiseAND(F.lit(ONES))).alias(f"s{i}") for i in range(LANES)]
    counted = hashed.groupBy(*key, "run").agg(F.count("h").alias("n"), *lanes)
    lane = lambda bit: F.shiftright(f"s{bit % 16}", 16 * (bit // 16)).bitwiseAND(F.lit(0xFFFF))
    total = counted.groupBy(*key).agg(F.sum("n").alias("n"), *[F.sum(lane(bit)).alias(f"b{bit}") for bit in range(64)])
    bits = [F.when(F.col(f"b{bit}") * 2 > F.col("n"), F.lit(1 << bit if bit < 63 else -(1 << 63))).otherwise(F.lit(0)) for bit in range(64)]
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2], strict=True)]
    return total.select(*key, bits[0].cast("long").alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two fingerprints."""
    return (F.lit(64) - F.bit_count(a.bitwiseXOR(b))) / F.lit(64.0)


def next_document(docs: DataFrame) -> DataFrame:
    """doc_id, text, place, next_id, next_text: the next row in descending id, after the last the first.

    ``place`` tells repeated rows apart.
    Ids are cut at quantiles into ranges of about ``RANGE_BYTES`` of text; a range is one window
    partition. The id at a cut is also dealt to the range above as its end, so no range has to look
    into another, and no window runs over the whole table.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    count, size, top = docs.where("doc_id is not null").select(F.count("*"), F.sum(F.octet_length("text")), F.max("doc_id")).first()
    ranges = min(MOST_RANGES, max(1, (size or 0) // RANGE_BYTES, count // 2_000))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = docs.select(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0] if shares and count else []
    cuts = sorted({c for c in cuts or [] if c < top}) if count else []
    # range b holds cuts[b-1] < id <= cuts[b]; found by position among the cuts
    places = F.array(*[F.lit(c).cast("long") for c in cuts]).cast("array<bigint>")
    found = F.size(F.filter(places, lambda c: c < F.col("doc_id")))
    if len(cuts) > 64:  # two steps of comparisons instead of one by one
        step = int(len(cuts) ** 0.5)
        coarse = F.array(*[F.lit(c).cast("long") for c in cuts[step - 1 :: step]])
        block = F.size(F.filter(coarse, lambda c: c < F.col("doc_id"))) * step
        found = block + F.size(F.filter(F.slice(places, block + 1, F.lit(step)), lambda c: c < F.col("doc_id")))
    here = F.struct(found.alias("part"), F.lit(0).alias("end"))
    above = F.when(F.array_contains(places, F.col("doc_id")), F.struct((found + 1).alias("part"), F.lit(1).alias("end")))
    around = F.when(F.col("doc_id") == F.lit(top), F.struct(F.lit(0).alias("part"), F.lit(2).alias("end")))
    dealt = texts.where("doc_id is not null").select("*", F.explode(F.array_compact(F.array(here, above, around))).alias("at"))
    window = Window.partitionBy("at.part").orderBy(F.when(F.col("at.end") == 2, 1).otherwise(0), F.col("doc_id").desc(), F.xxhash64("text"))
    linked = dealt.select(
        "doc_id", "text", "at", F.row_number().over(window).cast("long").alias("place"),
        F.lead("doc_id").over(window).alias("next_id"), F.lead("text").over(window).alias("next_text"),
    )
    # equal texts without an id are counted and then numbered, so that a task that runs again numbers them as before
    alone = texts.where("doc_id is null").groupBy("doc_id", "text").agg(F.count("*").alias("n"))
    alone = alone.select("doc_id", "text", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("place"), F.col("doc_id").alias("next_id"), F.lit("").alias("next_text"))
    return linked.where("at.end = 0").drop("at").unionByName(alone)


def within(queries: DataFrame, prints: DataFrame, radius: int = 3, spare: int = 3, greater: bool = False) -> DataFrame:
    """(q, fp, distance): for each fingerprint of ``queries`` those of ``prints`` within ``radius`` bits, itself included.

    Both have a column ``fp`` of distinct values. A pair is reported once, by the first table that it agrees
    in; ``greater`` leaves only fp > q. A side of few rows is broadcast, else both are dealt by table and key.
    Null fingerprints match nothing; values that are not distinct give a row for each; empty sides give no rows; further columns are not read.
    """
    blocks = radius + spare
    edge = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(blocks)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masks = [signed(sum(block[i] for i in chosen)) for chosen in combinations(range(blocks), spare)]
    keys = F.array(*[F.struct(F.lit(k).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)])
    dealt = lambda df: df.select("fp", F.explode(keys).alias("k")).select("fp", "k.table", "k.key")
    a, b = dealt(queries).alias("a"), dealt(prints).alias("b")
    apart = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    first = F.lit(len(masks))
    for k, m in reversed(list(enumerate(masks))):
        first = F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(k)).otherwise(first)
    near = (F.col("a.table") == F.col("b.table")) & (F.col("a.key") == F.col("b.key")) & (F.bit_count(apart) <= radius) & (first == F.col("a.table"))
    near = near & (F.col("a.fp") < F.col("b.fp")) if greater else near
    return a.join(b, near).select(F.col("a.fp").alias("q"), F.col("b.fp").alias("fp"), F.bit_count(apart).cast("int").alias("distance"))


def near_pairs(prints: DataFrame, radius: int = 3, spare: int = 3) -> DataFrame:
    """Pairs (a < b, distance) of distinct fingerprints in column ``fp`` within ``radius`` bits.

    Identical fingerprints are one node: join ``prints`` on ``fp`` for the documents of each, rather than
    expanding them into pairs. Null fingerprints, an empty table and a single value give no pairs; further columns, whatever their names, are not read.
    """
    own = prints.select("fp").distinct().where("fp is not null")
    return within(own, own, radius, spare, greater=True).select(F.col("q").alias("a"), F.col("fp").alias("b"), "distance")


def near_counts(prints: DataFrame, asked: Column, radius: int = 3, spare: int = 3) -> DataFrame:
    """(fp, n_near) for the fingerprints of rows that are ``asked``: how many rows lie within ``radius`` bits, the fingerprint's own included.

    Rows of one fingerprint count each; null fingerprints, and tables without rows or without any that is asked, give no rows.
    """
    own = prints.groupBy("fp").agg(F.count("*").alias("rows"))
    queries = small(written(prints.where(asked).select("fp").distinct()), 10_000)
    found = within(queries, own.select("fp"), radius, spare)
    return found.join(own, "fp").groupBy(F.col("q").alias("fp")).agg(F.sum("rows").alias("n_near"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """The rows of query op4: fingerprints of every text and of its edited text, and their likeness.

    A row without a next document (null id) is edited with nothing and has near_next 0. Every row whose id is
    divisible by ``SEARCHED`` is looked for among all rows: ``n_near`` other rows lie within three bits.
    """
    linked = next_document(docs)
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    versions = F.array(F.struct(F.lit(0).alias("v"), F.col("text").alias("t")), F.struct(F.lit(1).alias("v"), edited.alias("t")))
    key = ["doc_id", "place", "next_id", "n_chars", "text_hash", "next_hash"]
    both = linked.select(
        "doc_id", "place", "next_id", n.cast("long").alias("n_chars"), F.xxhash64("text").alias("text_hash"), F.xxhash64("next_text").alias("next_hash"), F.explode(versions).alias("x")
    )
    both = both.select(*key, "x.v", F.when(F.col("x.v") == 1, F.sha2("x.t", 256)).alias("sha"), "x.t")
    prints = fingerprints(both, [*key, "v", "sha"], "t", "fp")
    rows = written(prints.groupBy(*key).agg(
        F.max("sha").alias("edited_sha256"), F.max(F.when(F.col("v") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("v") == 1, F.col("fp"))).alias("edited_fp"),
    ))
    asked = F.col("doc_id") % SEARCHED == 0
    near = small(written(near_counts(rows, asked)))
    following = rows.where("doc_id is not null").groupBy(F.col("doc_id").alias("next_id"), F.col("text_hash").alias("next_hash")).agg(F.min("fp").alias("next_fp"))
    as_text = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    joined = rows.join(following, ["next_id", "next_hash"], "left").join(near, "fp", "left")
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", as_text("fp").alias("fingerprint"), as_text("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), F.coalesce(likeness(F.col("fp"), F.col("next_fp")), F.lit(0.0)).alias("near_next"),
        F.when(asked, F.col("n_near") - 1).alias("n_near"),
    )
