"""Facts of pictures from the first bytes of their files: kind, width and height, without a picture library. G16

PNG, GIF, BMP and WebP say their size at fixed places, which is an expression on the file's first bytes. JPEG and TIFF have to be walked, which a small helper does in
Arrow batches, for their rows only. The content is dropped with the scan, before anything shuffles.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import IMAGE_SUFFIXES

FACTS = "kind string, width int, height int"
# How files of each kind begin, as hexadecimal digits.
BEGINNINGS = {"png": ("89504E470D0A1A0A",), "gif": ("474946383761", "474946383961"), "bmp": ("424D",), "jpeg": ("FFD8FF",), "tiff": ("49492A00", "4D4D002A"), "webp": ("52494646",)}
# Markers of a JPEG file that begin a frame, and those without a length.
FRAMES, BARE = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}, frozenset((0x01, *range(0xD0, 0xDA)))
# TIFF tags of the size, and the width of the types that they may have.
TIFF_SIZE, TIFF_TYPES = {256: "width", 257: "height"}, {1: "B", 3: "H", 4: "I"}


def _number(content: Column, at: int, size: int, little: bool = False) -> Column:
    digits = F.hex(F.substring(content, at + 1, size))
    turned = F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in reversed(range(size))]) if little else digits
    return F.conv(F.when(F.length(digits) == 2 * size, turned), 16, 10).cast("bigint")


def kind_of(content: Column) -> Column:
    """The kind that a file's first bytes tell, or null."""
    out = F.lit(None).cast("string")
    for kind, begins in BEGINNINGS.items():
        for b in begins:
            out = F.when(F.hex(F.substring(content, 1, len(b) // 2)) == b, F.lit(kind)).otherwise(out)
    return out


def jpeg_size(data: bytes) -> tuple[int, int] | None:
    """Width and height of the first frame, its markers being walked by their lengths."""
    at = 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
        elif marker in BARE:
            at += 2
        elif marker in FRAMES:
            return struct.unpack(">HH", data[at + 5 : at + 9])[::-1] if at + 9 <= len(data) else None
        else:
            at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    return None


def tiff_size(data: bytes) -> tuple[int, int] | None:
    """Width and height of the first image, from the tags of its directory."""
    order = "<" if data[:2] == b"II" else ">"
    found: dict[str, int] = {}
    try:
        (at,) = struct.unpack_from(order + "I", data, 4)
        (n,) = struct.unpack_from(order + "H", data, at)
        for i in range(n):
            tag, kind, _, _ = struct.unpack_from(order + "HHII", data, at + 2 + 12 * i)
            if tag in TIFF_SIZE and kind in TIFF_TYPES:
                (found[TIFF_SIZE[tag]],) = struct.unpack_from(order + TIFF_TYPES[kind], data, at + 10 + 12 * i)
    except struct.error:
        return None
    return (found["width"], found["height"]) if len(found) == 2 else None


def _walked(content_at: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes = [(jpeg_size(d) if d[:2] == b"\xff\xd8" else tiff_size(d)) if d else None for d in (x.as_py() for x in batch.column(content_at))]
            width, height = (pa.array([s and s[i] for s in sizes], pa.int32()) for i in (0, 1))
            kept = [c for c in range(batch.num_columns) if c != content_at]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], width, height], names=[*[batch.schema.names[c] for c in kept], "width", "height"])

    return run


def facts(files: DataFrame, content: str = "content") -> DataFrame:
    """``files`` with (kind, width, height) in place of their content; null where a file is none of the kinds, or is cut off."""
    rest = [c for c in files.columns if c != content]
    c = F.col(content)
    known = files.withColumn("kind", kind_of(c))
    at = F.col("kind")
    # a bitmap's height is negative if its rows come from the top
    bmp_height = F.abs(_number(c, 22, 4, True) - F.when(_number(c, 22, 4, True) >= 1 << 31, 1 << 32).otherwise(0))
    chunk = F.substring(c, 13, 4).cast("string")
    vp8l = _number(c, 21, 4, True)
    webp = {
        "width": F.when(chunk == "VP8X", _number(c, 24, 3, True) + 1).when(chunk == "VP8L", vp8l.bitwiseAND(0x3FFF) + 1).when(chunk == "VP8 ", _number(c, 26, 2, True).bitwiseAND(0x3FFF)),
        "height": F.when(chunk == "VP8X", _number(c, 27, 3, True) + 1).when(chunk == "VP8L", F.shiftright(vp8l, 14).bitwiseAND(0x3FFF) + 1).when(chunk == "VP8 ", _number(c, 28, 2, True).bitwiseAND(0x3FFF)),
    }
    width = F.when(at == "png", _number(c, 16, 4)).when(at == "gif", _number(c, 6, 2, True)).when(at == "bmp", _number(c, 18, 4, True)).when(at == "webp", webp["width"])
    height = F.when(at == "png", _number(c, 20, 4)).when(at == "gif", _number(c, 8, 2, True)).when(at == "bmp", bmp_height).when(at == "webp", webp["height"])
    walk = F.coalesce(at.isin("jpeg", "tiff"), F.lit(False))
    here = known.where(~walk).select(*rest, "kind", width.cast("int").alias("width"), height.cast("int").alias("height"))
    some = known.where(walk).select(*rest, "kind", content)
    schema = "width int, height int"
    from pyspark.sql.types import StructType

    there = some.mapInArrow(_walked(len(rest) + 1), StructType([*some.drop(content).schema.fields, *StructType.fromDDL(schema).fields]))
    return here.unionByName(there)


def scan(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(path, length, kind, width, height) of the pictures below a folder."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root)
    named = listed.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*IMAGE_SUFFIXES, "gif", "webp"))
    return facts(named.select("path", "length", "content"))
