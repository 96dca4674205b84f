"""Rewriting of the strings in open JSON (VARIANT) at any depth, keys and everything else untouched; JSON-safe rows.

Compact JSON text is cut at its quotes. Escaped quotes and backslashes are set aside before, by control characters that JSON text
cannot hold, so that the pieces between quotes are in turn syntax and strings, and a string is a key if a colon follows it. Nothing is
matched by a pattern that could take one for the other, and the work is linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import let

_BACKSLASH, _QUOTE = "\x01", "\x02"


def _content(piece: Column) -> Column:
    """The string that a piece between quotes stands for."""
    plain = F.replace(F.replace(piece, F.lit(_QUOTE), F.lit('"')), F.lit(_BACKSLASH), F.lit("\\"))
    text = F.replace(F.replace(piece, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    quoted = F.try_variant_get(F.try_parse_json(F.concat(F.lit('"'), text, F.lit('"'))), "$", "string")
    return F.when(piece.contains("\\"), quoted).otherwise(plain)


def _quoted(string: Column) -> Column:
    """A string as JSON writes it, without its quotes."""
    return let(F.to_json(F.array(string)), lambda j: F.substring(j, F.lit(3), F.char_length(j) - 4))


def map_strings(value: Column, change: Callable[[Column], Column]) -> Column:
    """A VARIANT with ``change`` applied to every string in it that is no key. Null stays null."""

    def rewritten(pieces: Column) -> Column:
        def one(piece: Column, i: Column) -> Column:
            is_value = (i % 2 == 1) & ~F.coalesce(F.get(pieces, i + 1).startswith(":"), F.lit(False))
            back = F.replace(F.replace(piece, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
            return F.when(is_value, _quoted(change(_content(piece)))).otherwise(back)

        return F.array_join(F.transform(pieces, one), '"')

    safe = F.replace(F.replace(F.to_json(value), F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    return F.parse_json(let(F.split(safe, '"', -1), rewritten))


def json_safe(value: Column, kind: T.DataType) -> Column:
    """A column as one that JSON can hold: numbers that are not finite are null, days and times are ISO texts, bytes are base64, and so in arrays, maps and structs; keys are texts."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    if isinstance(kind, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if isinstance(kind, T.BinaryType):
        return F.base64(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: json_safe(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(F.transform_keys(value, lambda k, v: k.cast("string")), lambda k, v: json_safe(v, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[json_safe(value[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return value


def safe_rows(df):
    """``df`` with every column as JSON can hold it."""
    return df.select(*[json_safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
