"""A grammar of Markdown texts: typed segments that put together give the text again, and edits of segments.

A text is cut first at its HTML tables, then into maximal runs of lines of one kind, each with its line ends, so that joining all segments
gives the text back, whatever it holds. Edits change the segments of one kind only; prose is never matched by a pattern of another kind.

Kinds: ``html`` (one HTML table), ``pipe`` (a pipe table: a row of pipes, a rule, and the rows below), ``seal`` (the section of seals that closes a text), ``prose``.
A closing section is a title line of its own, an empty line, and lines without an empty line between them up to the end of the text; such a title
anywhere else is prose.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .text import let

# Fixed value: the title of the section of seals.
SEAL_TITLE = "印章："
HTML_TABLE = r"(?is)<table\b[^>]*>.*?</\s*table\s*>"
PIPE_ROW, PIPE_RULE = r"^\s*\|.*\|\s*$", r"^\s*\|?[ \t]*:?-+:?[ \t]*(\|[ \t]*:?-+:?[ \t]*)*\|?\s*$"
SEGMENT = "array<struct<kind: string, text: string>>"


def _segment(kind: str, text: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), text.alias("text"))


def lines_of(text: Column) -> Column:
    """The lines of a text with their ends; an empty text has none."""
    return F.regexp_extract_all(text, F.lit("[^\n]*\n|[^\n]+$"), F.lit(0))


def _runs(piece: Column) -> Column:
    """Segments of a text without HTML tables: runs of rows of pipes whose second row is a rule are tables, other runs are prose."""

    def of_lines(lines: Column) -> Column:
        def cut(piped: Column) -> Column:
            edges = F.filter(F.transform(piped, lambda x, i: F.when((i == 0) | (x != F.get(piped, i - 1)), i)), lambda i: i.isNotNull())

            def run(a: Column, b: Column) -> Column:
                table = F.get(piped, a) & (b - a > 1) & F.get(lines, a + 1).rlike(PIPE_RULE)
                return F.struct(F.when(table, F.lit("pipe")).otherwise(F.lit("prose")).alias("kind"), F.array_join(F.slice(lines, a + 1, b - a), "").alias("text"))

            return let(edges, lambda e: F.transform(e, lambda a, k: run(a, F.coalesce(F.get(e, k + 1), F.size(lines)))))

        return let(F.transform(lines, lambda x: x.rlike(PIPE_ROW)), cut)

    return F.when(piece == "", F.array().cast(SEGMENT)).when(~piece.contains("|"), F.array(_segment("prose", piece))).otherwise(let(lines_of(piece), of_lines))


def _with_tables(body: Column) -> Column:
    between, tables = F.split(body, HTML_TABLE, -1), F.regexp_extract_all(body, F.lit(HTML_TABLE), F.lit(0))
    parts = lambda pieces, found: F.flatten(F.transform(pieces, lambda p, i: F.concat(_runs(p), F.when(i < F.size(found), F.array(_segment("html", F.get(found, i)))).otherwise(F.array().cast(SEGMENT)))))
    return F.when(~F.lower(body).contains("<table"), _runs(body)).otherwise(let(F.struct(between.alias("b"), tables.alias("t")), lambda v: parts(v["b"], v["t"])))


def _closing(text: Column) -> Column:
    """The section of seals at the end of a text, from its title; empty if there is none."""
    head = SEAL_TITLE + "\n\n"
    tail = F.substring_index(text, head, -1)
    section = F.concat(F.lit(head), tail)
    before = F.left(text, F.char_length(text) - F.char_length(section))
    alone = (before == "") | before.endswith("\n\n")
    whole = T.strip(tail) != ""
    return F.when(text.contains(head) & alone & whole & ~T.strip(tail).rlike(r"\n[ \t]*\n"), section).otherwise(F.lit(""))


def segments(markdown: Column) -> Column:
    """The segments of a text, in order; a null text has none."""
    return let(F.coalesce(markdown, F.lit("")), lambda t: let(_closing(t), lambda c: F.concat(
        _with_tables(F.left(t, F.char_length(t) - F.char_length(c))), F.when(c != "", F.array(_segment("seal", c))).otherwise(F.array().cast(SEGMENT)),
    )))


def joined(parts: Column) -> Column:
    """The text of segments."""
    return F.array_join(F.transform(parts, lambda s: s["text"]), "")


def edited(markdown: Column, **edits: Callable[[Column], Column]) -> Column:
    """A text with the segments of the named kinds changed by functions of their texts."""

    def one(s: Column) -> Column:
        out = s["text"]
        for kind, edit in edits.items():
            out = F.when(s["kind"] == kind, edit(s["text"])).otherwise(out)
        return out

    return F.array_join(F.transform(segments(markdown), one), "")


def cells_of(row: Column) -> Column:
    """The cells of a row of pipes, trimmed; escaped pipes do not part cells and stay escaped."""
    inner = F.regexp_replace(T.strip(row), r"^\||(?<!\\)\|$", "")
    return F.transform(F.split(inner, r"(?<!\\)\|", -1), T.strip)


def row_of(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def spaced_apart(parts: Column, is_block: Callable[[Column], Column]) -> Column:
    """The text of segments with an empty line on both sides of those that must stand alone; between two of these there is one, which the first brings."""

    def one(s: Column, i: Column) -> Column:
        before, after = F.get(parts, i - 1)["text"], F.get(parts, i + 1)["text"]
        lead = F.when(is_block(F.get(parts, i - 1)), F.lit("")).when(before.isNull() | before.rlike(r"(^|\n)[ \t]*\n\z"), F.lit("")).when(before.endswith("\n"), F.lit("\n")).otherwise(F.lit("\n\n"))
        last = after.isNull() | (T.strip(F.coalesce(after, F.lit(""))) == "")
        tail = F.when(last | after.rlike(r"^[ \t]*\n[ \t]*\n"), F.lit("")).when(after.rlike(r"^[ \t]*\n"), F.lit("\n")).otherwise(F.lit("\n\n"))
        return F.when(is_block(s), F.concat(lead, F.regexp_replace(s["text"], r"\n+\z", ""), tail)).otherwise(s["text"])

    return F.array_join(F.transform(parts, one), "")


# Characters that no entity decodes to: ends of cells, rows and tables.
_CELL, _ROW, _TABLE = "\x01", "\x02", "\x03"


def _raw_cells(html: Column) -> Column:
    """The cells of a table as one text, entities not decoded."""
    inner = lambda r: F.transform(F.regexp_extract_all(r, F.lit(T.CELL), F.lit(1)), lambda x: F.regexp_replace(T.strip_tags(x), f"[{_CELL}{_ROW}{_TABLE}]", " "))
    rows = F.filter(F.transform(F.split(html, r"(?i)</\s*tr\s*>"), inner), lambda r: F.size(r) > 0)
    return F.array_join(F.transform(rows, lambda r: F.array_join(r, _CELL)), _ROW)


def pipe_table_of(cells: Column) -> Column:
    """A pipe table of the cells of ``_raw_cells``, the first row as its head."""

    def shown(rows: Column) -> Column:
        line = lambda r: row_of(F.transform(F.split(r, _CELL), lambda c: F.replace(T.squeeze(c), F.lit("|"), F.lit("\\|"))))
        rule = F.concat(F.repeat(F.lit("| --- "), F.size(F.split(rows[0], _CELL))), F.lit("|"))
        return F.array_join(F.concat(F.array(line(rows[0]), rule), F.transform(F.slice(rows, 2, F.size(rows)), line)), "\n")

    return let(F.split(cells, _ROW), shown)


def pipes_for_html(texts: DataFrame, column: str = "markdown") -> DataFrame:
    """``texts`` with the HTML tables of ``column`` as pipe tables, each between empty lines; those without cells stay as they are.

    The cells of all tables of a text are decoded at once, in Python only where they hold unusual entities.
    """
    parts = texts.withColumn("_parts", segments(F.col(column)))
    html = F.filter("_parts", lambda s: s["kind"] == "html")
    raw = parts.withColumn("_raw", F.array_join(F.transform(html, lambda s: _raw_cells(s["text"])), _TABLE))
    plain = T.with_decoded(raw, "_raw")
    tables = F.split("_raw", _TABLE, -1)

    def changed(parts: Column, cells: Column) -> Column:
        made = lambda n: F.struct(F.lit("made").alias("kind"), pipe_table_of(F.get(cells, n)).alias("text"))
        nth = lambda at, i: (F.array_position(at, i) - 1).cast("int")
        new = let(_places(parts, "html"), lambda at: F.transform(parts, lambda s, i: F.when((s["kind"] == "html") & (F.get(cells, nth(at, i)) != ""), made(nth(at, i))).otherwise(s)))
        return let(new, lambda p: spaced_apart(p, lambda s: s["kind"] == "made"))

    body = F.when(F.size(html) == 0, F.col(column)).otherwise(let(F.struct("_parts", tables.alias("t")), lambda v: changed(v["_parts"], v["t"])))
    return plain.withColumn("_new", body).select(*[F.col("_new").alias(c) if c == column else F.col(f"`{c}`") for c in texts.columns])


def _places(parts: Column, kind: str) -> Column:
    """Where the segments of a kind are."""
    return F.filter(F.transform(parts, lambda s, i: F.when(s["kind"] == kind, i)), lambda i: i.isNotNull())


def rebuilt_tables(markdown: Column, tables: Column) -> Column:
    """A text whose pipe tables are, in order, those of ``tables`` (array of texts); tables beyond those of the text follow it, those that are missing leave the text's own."""

    def changed(parts: Column, given: Column) -> Column:
        nth = lambda at, i: (F.array_position(at, i) - 1).cast("int")
        made = lambda t: F.struct(F.lit("made").alias("kind"), t.alias("text"))
        swapped = let(_places(parts, "pipe"), lambda at: F.transform(parts, lambda s, i: F.when((s["kind"] == "pipe") & (nth(at, i) < F.size(given)), made(F.get(given, nth(at, i)))).otherwise(s)))
        more = F.transform(F.filter(given, lambda t, i: i >= F.size(F.filter(parts, lambda s: s["kind"] == "pipe"))), made)
        body = F.filter(F.concat(swapped, F.coalesce(more, F.array().cast(SEGMENT))), lambda s: s["text"] != "")
        return let(body, lambda p: spaced_apart(p, lambda s: s["kind"] == "made"))

    return let(F.struct(segments(markdown).alias("p"), F.coalesce(tables, F.array().cast("array<string>")).alias("t")), lambda v: changed(v["p"], v["t"]))
