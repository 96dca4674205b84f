"""Coercion of loosely typed values, as column expressions: null rather than an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(value: Column) -> Column:
    """A finite number or null."""
    v = value.try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def as_int(value: Column) -> Column:
    return value.try_cast("int")


def confidence(value: Column) -> Column:
    """A number from 0 to 1, else null."""
    v = as_double(value)
    return F.when(v.between(0.0, 1.0), v)


# Words for true and false.
TRUE_WORDS = ("1", "true", "yes", "y", "on")
FALSE_WORDS = ("0", "false", "no", "n", "off")


def as_boolean(value: Column, default: bool = False) -> Column:
    word = F.lower(F.trim(value.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False)).otherwise(F.lit(default))


def page_index(value: Column, position: Column) -> Column:
    """A page number, the position where there is none."""
    return F.coalesce(as_int(value), position.cast("int"))


def not_negative(value: Column) -> Column:
    v = as_int(value)
    return F.when(v >= 0, v)


def text_or(value: Column, default: str | None = None) -> Column:
    """Trimmed, the default where blank."""
    return F.coalesce(F.nullif(F.regexp_replace(value, "^(?U)\\s+|(?U)\\s+$", ""), F.lit("")), F.lit(default).cast("string"))


def even(value: Column, digits: int) -> Column:
    """A double to some decimals, half to even as doubles are computed: ``bround`` goes by the shortest decimal that a double is written as, which tells other halves."""
    by = float(10**digits)
    return F.when(F.abs(value * by) < float("inf"), F.rint(value * by) / by).otherwise(value)


def seconds_per_page(per_page: Column, elapsed: Column, pages: Column, rate: Column) -> Column:
    """As given, 0 too; else from elapsed time and pages, else from pages a second, both to three decimals; else infinite."""
    derived = F.when(pages != 0, even(F.coalesce(elapsed, F.lit(0.0)) / pages, 3))
    inverse = F.when(rate != 0, even(F.lit(1.0) / rate, 3))
    return F.coalesce(per_page, derived, inverse, F.lit(float("inf")))


def trial_key(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("none")) for p in parts])


def sorted_distinct(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))


def artifact_uri(artifacts: Column, kind: str) -> Column:
    """Address of the first artifact of a kind."""
    return F.try_element_at(F.filter(artifacts, lambda a: a["kind"] == kind), F.lit(1)).getField("uri")


def coverage(part: Column, whole: Column) -> Column:
    """Share of the distinct elements of ``part`` that ``whole`` has."""
    own = F.array_distinct(part)
    return F.size(F.array_intersect(own, whole)) / F.greatest(F.lit(1), F.size(own))
