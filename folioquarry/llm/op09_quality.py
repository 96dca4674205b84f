"""Quality rules: words and lines of a text, and how many documents of its host share its lines.

Lines are normalised (ASCII letters folded, digits made one, punctuation and white space reduced to
word breaks) and hashed. The documents of a host that hold a line are counted, each document once;
a line above the limit, more than ``least_docs`` and more than ``share`` of the host's documents, is
boilerplate and is removed from the text. A document of which less than ``left`` of its words or fewer than
``min_words`` remain is depleted and rejected. Documents that the base rules fail are rejected too.

Lines are reduced to one row per (host, line, document) and then to counts, both pre-aggregated before they
shuffle, so neither a hot host nor a line of a third of all documents meets in one task; the join back to
documents moves hashes, not text, and is one that Spark splits where it is skewed. Texts are read again only where
a line is to be removed.

Defined results: a null text has no words, fails and stays null; a null host is a host of its own; rows of one id are one
document in the counts and get a row each; rows with a null id are documents of their own; an empty table gives no rows;
texts of any length are worked whole, in blocks; a text of which all lines go becomes empty; further columns are kept by
``clean``, whatever their names, but those of the results are replaced. Hashes have 64 bits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, scratch, small, written
from .wordhash import LOWER, SEPARATOR, blocks, byte_rows, runs, shingle_hashes, span_hashes, word_hashes

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[10] = True
#: Bytes of a normalised line; punctuation becomes a word break.
NORMAL = LOWER.copy()
NORMAL[48:58] = 48
NORMAL[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 32

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULTS = [*COUNTS, "base_failed", "removed_words", "kept"]


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 3:
        return 0
    _, which, counts = np.unique(shingle_hashes(words, 3), return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def text_facts(data: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The five counts of a text, and hash and word count of each distinct normalised line, with its repeats."""
    words = word_hashes(data)
    chars = symbols = 0
    raw, normal, sizes = [], [], []
    for part in blocks(data, NEWLINE):
        if not len(part):
            continue
        solid = ~SEPARATOR[part]
        chars += int((solid & ((part & 0xC0) != 0x80)).sum())
        symbols += int(SYMBOL[part].sum())
        starts, ends = runs(part != 10)
        upto = np.concatenate(([0], np.cumsum(solid)))
        some = upto[ends] > upto[starts]
        raw.append(span_hashes(part, starts[some], ends[some]))
        form = NORMAL[part]
        at, to = runs(~SEPARATOR[form])
        if len(at):
            lines = np.searchsorted(starts, at, side="right")
            first = np.flatnonzero(np.concatenate(([True], lines[1:] != lines[:-1])))
            last = np.append(first[1:], len(at))
            normal.append(span_hashes(span_hashes(form, at, to), first, last))
            sizes.append(last - first)
    raw = np.concatenate(raw) if raw else np.empty(0, np.uint64)
    counts = [len(words), chars, symbols, len(raw) - len(np.unique(raw)), repeated_words(words)]
    if not normal:
        return counts, np.empty(0, np.int64), np.empty(0, np.int64)
    lines, which = np.unique(np.concatenate(normal), return_inverse=True)
    return counts, lines.view(np.int64), np.bincount(which, weights=np.concatenate(sizes)).astype(np.int64)


def _facts(batches):
    """(..., text) -> all but the text, the counts of the text, and its distinct lines with their sizes."""
    import pyarrow as pa

    for batch in batches:
        counts, lines, sizes = [], [], []
        for data in byte_rows(batch.column(batch.num_columns - 1)):
            c, h, n = text_facts(data if data is not None else np.empty(0, np.uint8))
            counts.append(c)
            lines.append(h)
            sizes.append(n)
        at = np.concatenate(([0], np.cumsum([len(x) for x in lines]))).astype(np.int32)
        as_list = lambda xs: pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(xs) if xs else np.empty(0, np.int64)))
        columns = batch.columns[:-1]
        columns += [pa.array(c, pa.int64()) for c in (np.array(counts, dtype=np.int64).T if counts else np.empty((5, 0), np.int64))]
        names = [*batch.schema.names[:-1], *COUNTS, "lines", "sizes"]
        yield pa.RecordBatch.from_arrays([*columns, as_list(lines), as_list(sizes)], names=names)


def without_lines(data: np.ndarray, gone: np.ndarray) -> bytes:
    """The lines of a text but those whose normal form has one of these hashes, joined as they were."""
    kept, last = [], False
    for part in blocks(data, NEWLINE):
        if not len(part):
            last = False
            continue
        breaks = np.flatnonzero(part == 10)
        starts, ends = np.concatenate(([0], breaks + 1)), np.append(breaks + 1, len(part))
        form = NORMAL[part]
        at, to = runs(~SEPARATOR[form])
        drop = np.zeros(len(starts), dtype=bool)
        if len(at):
            lines = np.searchsorted(starts, at, side="right") - 1
            first = np.flatnonzero(np.concatenate(([True], lines[1:] != lines[:-1])))
            hashes = span_hashes(span_hashes(form, at, to), first, np.append(first[1:], len(at)))
            drop[lines[first]] = np.isin(hashes.view(np.int64), gone)
        step = np.zeros(len(part) + 1, dtype=np.int8)
        np.add.at(step, starts[drop], 1)
        np.add.at(step, ends[drop], -1)
        kept.append(part[np.cumsum(step[:-1]) == 0].tobytes())
        last = bool(drop[-1])
    text = b"".join(kept)
    return text[:-1] if last else text


def _stripped(at: int):
    """(row, gone, ...) -> the row's columns with the text (column ``at``) without its lines in ``gone``, and what follows."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            row, columns = batch.column(0), batch.column(0).flatten()
            gone = batch.column(1).to_pylist()
            texts = [None if d is None else without_lines(d, np.array(g, dtype=np.int64)).decode("utf-8", "replace") for d, g in zip(byte_rows(columns[at]), gone, strict=True)]
            columns[at] = pa.array(texts, columns[at].type)
            more = batch.schema.names[2:]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[2:]], names=[*(f.name for f in row.type), *more])

    return run


KEY = ["doc_id", "host", "text_hash"]


def _keyed(docs: DataFrame, host: str) -> DataFrame:
    """``docs`` as one struct, so that its columns cannot clash with the working ones, with what tells its texts apart."""
    of = F.coalesce(F.concat(F.lit("="), F.col(f"doc.{host}").cast("string")), F.lit(""))
    return docs.select(F.struct(*docs.columns).alias("doc")).select("doc", F.col("doc.doc_id").alias("doc_id"), of.alias("host"), F.xxhash64("doc.text").alias("text_hash"))


def marks(
    docs: DataFrame, host: str = "source", min_words: int = 50, repeat_percent: int = 50,
    least_docs: int = 10, share: float = 0.02, left: float = 0.5,
) -> DataFrame:
    """doc_id, host, text_hash, sha (of the text), the counts, base_failed, removed_words, kept, gone (the lines to remove, or null); a row per row of ``docs``."""
    # rows are numbered once, with the table; all that follows reads these numbers
    given = _keyed(docs, host).select(*KEY, F.monotonically_increasing_id().alias("row"), F.sha2(F.coalesce("doc.text", F.lit("")), 256).alias("sha"), F.col("doc.text").alias("text"))
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in given.drop("text").schema], *[f"{c} bigint" for c in COUNTS], "lines array<bigint>", "sizes array<bigint>"])
    with scratch(docs.sparkSession):
        facts = written(mapped(given, _facts, schema))
        document = F.when(F.col("doc_id").isNull(), F.xxhash64("row", F.lit(2))).otherwise(F.xxhash64("doc_id", F.lit(1))).alias("doc")
        lines = facts.select("host", "row", document, F.explode(F.arrays_zip("lines", "sizes")).alias("l")).select("host", "row", "doc", F.col("l.lines").alias("line"), F.col("l.sizes").alias("n"))
        hosts = small(written(facts.select("host", document).distinct().groupBy("host").agg(F.count("*").alias("host_docs"))))
        counted = lines.select("host", "line", "doc").distinct().groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > least_docs)
        common = small(written(counted.join(hosts, "host").where(F.col("docs") > F.col("host_docs") * share).select("host", "line")))
        removed = lines.join(common, ["host", "line"]).groupBy("row").agg(F.sum("n").alias("removed_words"), F.collect_list("line").alias("gone"))
        words = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)
        joined = facts.withColumn("total", words).drop("lines", "sizes").join(removed, "row", "left")
        gone = F.coalesce("removed_words", F.lit(0))
        base_failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * repeat_percent)
        depleted = (gone > 0) & ((F.col("total") - gone < min_words) | (F.col("total") - gone < F.col("total") * left))
        return written(joined.select(
            *KEY, "sha", *COUNTS, base_failed.alias("base_failed"), gone.cast("bigint").alias("removed_words"), (~base_failed & ~depleted).alias("kept"), "gone",
        ), keep=True)


def _same_text(a: str, b: str) -> Column:
    return (F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))) & (F.col(f"{a}.host") == F.col(f"{b}.host")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))


def clean(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """``docs`` without boilerplate lines in ``text``, with the counts of the texts as they came, base_failed, removed_words and kept."""
    docs = docs.select(*[c for c in docs.columns if c not in RESULTS])
    found = marks(docs, host, **limits).dropDuplicates(KEY)  # rows of one key have equal results
    both = _keyed(docs, host).alias("d").join(small(found).alias("f"), _same_text("d", "f"))
    results = [F.col(f"f.{c}") for c in RESULTS]
    whole = both.where("f.gone is null").select("d.doc.*", *results)
    less = mapped(both.where("f.gone is not null").select("d.doc", "f.gone", *results), _stripped(docs.columns.index("text")), whole.schema)
    return whole.unionByName(less)


def quality_rows(docs: DataFrame) -> DataFrame:
    """The rows of query op9: doc_id, the counts, base_failed, removed_words, kept, and the digest of the text without boilerplate lines."""
    docs = docs.select("doc_id", "source", "text")
    found = marks(docs)
    # texts are read again only for documents that lose a line
    gone = small(found.where("gone is not null").select(*KEY, "gone").dropDuplicates(KEY))
    again = _keyed(docs, "source").alias("d").join(gone.alias("g"), _same_text("d", "g")).select(F.struct("d.doc.text").alias("doc"), "g.gone", *[f"d.{c}" for c in KEY])
    texts = mapped(again, _stripped(0), f"text string, doc_id {dict(found.dtypes)['doc_id']}, host string, text_hash bigint")
    shas = texts.select(*KEY, F.sha2("text", 256).alias("less")).dropDuplicates(KEY)
    joined = found.alias("f").join(shas.alias("s"), _same_text("f", "s"), "left")
    return joined.select("f.doc_id", *[F.col(f"f.{c}") for c in RESULTS], F.coalesce("s.less", "f.sha").alias("clean_sha256"))
