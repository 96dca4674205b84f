"""Many words in many texts: one automaton a worker finds all words of a list in one pass over a text.

The cost of a text grows with its length and its hits, not with the list. A list is the caller's; it goes to the workers in slices of
``SLICE`` words, each a bounded size, and the texts are passed once for each slice, so no list is too long and none is joined to the texts
by a condition that is no equality. Of short lists (``PLAIN``) it is told in the JVM, by the plan itself, which texts hold them.

Defined results: empty and null words find nothing; equal words are one; null texts hold nothing; the occurrences of one word don't
overlap (the leftmost counts, then the next after its end), those of different words may; ranges are code points, the end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import in_batches

#: Words of a list that are sought by expressions of the JVM; longer lists by an automaton.
PLAIN = 24
#: Words, and their characters, that go to a worker at once.
SLICE, SLICE_CHARS = 100_000, 4_000_000
#: Hits, and bytes of the texts repeated with them, that leave a worker at once.
HITS, HIT_BYTES = 8192, 4 << 20

_built: dict[int, tuple[list[str], object]] = {}


def automaton(words: list[str]):
    """The automaton of a list, kept while the worker's tasks use the same list."""
    import ahocorasick

    key = hash(tuple(words))
    found = _built.get(key)
    if found is None or found[0] != words:
        machine = ahocorasick.Automaton()
        for i, word in enumerate(words):
            machine.add_word(word, (i, len(word)))
        machine.make_automaton()
        _built.clear()  # one list at a time
        found = _built[key] = (words, machine)
    return found[1]


def slices(words: DataFrame, word: str = "word") -> Iterator[list[str]]:
    """The distinct words in lists of at most ``SLICE`` words and ``SLICE_CHARS`` characters, or of a single longer one."""
    distinct = words.select(F.col(word).alias("w")).where("w <> ''").distinct()
    total, chars = distinct.agg(F.count("*"), F.coalesce(F.sum(F.char_length("w")), F.lit(0))).first()
    n = max(1, -(-2 * total // SLICE), -(-2 * chars // SLICE_CHARS)) if total > SLICE or chars > SLICE_CHARS else 1
    for k in range(n):
        part = distinct if n == 1 else distinct.where(F.pmod(F.xxhash64("w"), F.lit(n)) == k)
        some = sorted(r.w for r in part.collect())
        if some:
            yield some


def _holds_any(text: str, words: list[str]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | F.col(text).contains(w)
    return hit


def _each_slice(rows: DataFrame, words: DataFrame, word: str, text: str, more: T.StructType, plain: Callable[[list[str]], Column] | None, work, keep_text: bool = True) -> DataFrame:
    """The union, over slices of the list, of ``rows`` with the columns ``more``, by expression where ``plain`` gives one for a short list, else by automaton.

    Without ``keep_text`` the text is left out, and is not repeated for each hit on the way from the worker.
    """
    left = [c for c in rows.columns if keep_text or c != text]
    schema = T.StructType([*[f for f in rows.schema.fields if f.name in left], *more.fields])
    out = None
    at = rows.columns.index(text)
    for some in slices(words, word):
        if len(some) <= PLAIN and plain:
            found = rows.withColumn("_hit", F.explode(plain(some))).select(*[F.col(f"`{c}`") for c in left], "_hit.*")
        else:
            # of a short list, only texts that hold a word leave the JVM
            near = rows.where(_holds_any(text, some)) if len(some) <= PLAIN else rows
            found = in_batches(near, _batches(work, some, at, keep_text, more), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = rows.where("false").select(*[F.col(f"`{c}`") for c in left], *[F.lit(None).cast(f.dataType).alias(f.name) for f in more.fields])
    return out


def _batches(work, words: list[str], at: int, keep_text: bool, more: T.StructType):
    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        machine, kinds = automaton(words), to_arrow_schema(more)
        for batch in batches:
            left = batch if keep_text else batch.select([n for i, n in enumerate(batch.schema.names) if i != at])

            def made(rows, hits, left=left):
                kept = left.take(pa.array(rows, pa.int64()))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*hits, strict=True), kinds, strict=True)]
                return pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*kept.schema.names, *kinds.names])

            rows, hits, size = [], [], 0
            for row, text in enumerate(batch.column(at).to_pylist()):
                for hit in work(machine, words, text) if text else ():
                    rows.append(row)
                    hits.append(hit)
                    size += 4 * len(text) if keep_text else 0
                    if len(hits) >= HITS or size >= HIT_BYTES:
                        yield made(rows, hits)
                        rows, hits, size = [], [], 0
            if hits:
                yield made(rows, hits)

    return run


def _occurrences(machine, words: list[str], text: str) -> Iterator[tuple[str, int, int]]:
    free: dict[int, int] = {}
    for last, (i, n) in machine.iter(text):
        start = last - n + 1
        if start >= free.get(i, 0):
            free[i] = last + 1
            yield words[i], start, last + 1


def _held(machine, words: list[str], text: str) -> Iterator[tuple[str]]:
    for i in sorted({i for _, (i, _) in machine.iter(text)}):
        yield (words[i],)


def occurrences(rows: DataFrame, words: DataFrame, word: str = "word", text: str = "text", keep_text: bool = True) -> DataFrame:
    """``rows``, without their text if that is not to be kept, with (word, char_start, char_end), a row for each occurrence of a word of the list in the text."""
    return _each_slice(rows, words, word, text, T.StructType.fromDDL("word string, char_start int, char_end int"), None, _occurrences, keep_text)


def held(rows: DataFrame, words: DataFrame, word: str = "word", text: str = "text") -> DataFrame:
    """``rows`` with (word), a row for each word of the list that the text holds."""
    plain = lambda some: F.transform(F.filter(F.array(*map(F.lit, some)), lambda w: F.col(text).contains(w)), lambda w: F.struct(w.alias("word")))
    return _each_slice(rows, words, word, text, T.StructType.fromDDL("word string"), plain, _held)


def holding(rows: DataFrame, words: DataFrame, word: str = "word", text: str = "text") -> DataFrame:
    """The rows whose text holds a word of the list at all; rows that are equal stay as many as they are."""
    lists = list(slices(words, word))
    if not lists:
        return rows.where("false")
    if sum(map(len, lists)) <= PLAIN:
        return rows.where(_holds_any(text, lists[0]))
    at = rows.columns.index(text)
    flagged = rows.withColumn("_any", F.lit(False))
    for some in lists:
        flagged = in_batches(flagged, _flags(some, at), flagged.schema)
    return flagged.where("_any").drop("_any")


def _flags(words: list[str], at: int):
    def run(batches):
        import pyarrow as pa

        machine = automaton(words)
        for batch in batches:
            texts, known = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            found = [k or (bool(t) and next(machine.iter(t), None) is not None) for t, k in zip(texts, known, strict=True)]
            yield batch.set_column(batch.num_columns - 1, "_any", pa.array(found, pa.bool_()))

    return run
