"""Files as rows: scans, artifact lookup, task sheets and inventories. Listings carry no content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import padded_number, safe_part, safe_stem, suffix, value_text

# What can be extracted from.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "tif", "tiff")
SUFFIXES = ("pdf", *IMAGE_SUFFIXES)
# Artifacts by the end of their names, and folders whose names say nothing.
ARTIFACT_KINDS = (
    ("_middle.json", "middle_json"), ("_content_list.json", "content_list_json"), ("_content_list_v2.json", "content_list_v2_json"), ("_model.json", "model_json"),
    (".md", "markdown"), ("_layout.pdf", "layout_pdf"), ("_span.pdf", "span_pdf"), ("_origin.pdf", "origin_pdf"),
)
GENERIC_FOLDERS = ("input", "inputs")


#: Bytes of a table up to which its rows are dealt over all cores where its files are fewer than these.
SMALL_TABLE = 256 << 20


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table. A small one in few files, which few tasks would read and work, is dealt over all cores once it is read; others are read as they lie."""
    table = spark.read.parquet(path)
    found, cores = table._jdf.inputFiles(), spark.sparkContext.defaultParallelism
    if len(found) >= cores:
        return table
    size = 0
    for f in found:
        at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f))
        size += at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).getLen()
    return table.repartition(cores) if size <= SMALL_TABLE else table


def is_supported(path: Column) -> Column:
    """S2"""
    return suffix(path).isin(*SUFFIXES)


def is_image(path: Column) -> Column:
    """F18"""
    return suffix(path).isin(*IMAGE_SUFFIXES)


def scan(spark: SparkSession, root: str, recursive: bool = True, limit: int | None = None) -> DataFrame:
    """(path, length, modified, ordinal) of supported files, one of each path in any case, in order of path."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root)
    files = listed.select("path", "length", F.col("modificationTime").alias("modified")).where(is_supported(F.col("path")))
    return first_paths(files, limit)


def first_paths(files: DataFrame, limit: int | None = None) -> DataFrame:
    """One file of each path in any case; ``limit`` (above 0) keeps the first in order of path."""
    one = files.withColumn("n", F.row_number().over(Window.partitionBy(F.lower("path")).orderBy("path"))).where("n = 1").drop("n")
    return one.orderBy(F.lower("path"), "path").limit(limit) if limit and limit > 0 else one


def path_problem(path: Column, exists: Column, is_file: Column) -> Column:
    """S3: why a path cannot be read, or null."""
    return F.when(~exists, F.lit("NOT_FOUND")).when(~is_file, F.lit("NOT_A_FILE")).when(~is_supported(path), F.lit("UNSUPPORTED"))


def local_path(uri: Column) -> Column:
    """The path of a file URI or of a plain path; null for other schemes."""
    scheme = F.lower(F.regexp_extract(uri, "^([A-Za-z][A-Za-z0-9+.-]+):", 1))
    return F.when(scheme == "file", F.url_decode(F.replace(F.regexp_replace(uri, "^(?i)file:(//[^/]*)?", ""), F.lit("+"), F.lit("%2B")))).when(scheme == "", uri)


def artifact_kind(path: Column) -> Column:
    """S25"""
    out = F.lit(None).cast("string")
    for end, kind in reversed(ARTIFACT_KINDS):
        out = F.when(path.endswith(end), F.lit(kind)).otherwise(out)
    return out


def artifacts(files: DataFrame) -> DataFrame:
    """(kind, uri) of a listing's known artifacts."""
    return files.select(artifact_kind(F.col("path")).alias("kind"), F.col("path").alias("uri")).where("kind is not null")


def exactly_one(found: DataFrame, *keys: str, wanted: DataFrame | None = None) -> DataFrame:
    """One row per key; a key with more raises an error, and so does one of ``wanted`` with none. Counting is pre-aggregated."""
    body = [c for c in found.columns if c not in keys]
    one = found.groupBy(*keys).agg(F.count("*").alias("n"), *[F.min(c).alias(c) for c in body])
    if wanted is not None:
        one = wanted.select(*keys).distinct().join(one, list(keys), "left")
    problem = F.when(F.col("n") > 1, F.raise_error(F.lit("AMBIGUOUS_ARTIFACT"))).when(F.col("n").isNull(), F.raise_error(F.lit("NO_ARTIFACT")))
    return one.where(problem.isNull()).drop("n")


def output_dir(path: Column, root: str, target: str) -> Column:
    """Where the output of an input goes: below the target, in the folders that it has below the root.

    A file directly in the root goes to a folder of the root's name, unless that is generic. A last folder that is named as the
    file's stem is left out, as the file's own folder is named so anyway. Names are made safe.
    """
    base, out = root.rstrip("/"), target.rstrip("/")
    inside = F.when(path.startswith(base + "/"), F.substring(path, len(base) + 2, 1 << 20)).otherwise(F.element_at(F.split(path, "/"), -1))
    name = safe_stem(path)
    parts = F.split(inside, "/")
    folders = F.transform(F.filter(F.slice(parts, 1, F.size(parts) - 1), lambda x: (x != "") & (x != ".")), lambda x: safe_part(x))
    own = safe_part(F.lit(base.rsplit("/", 1)[-1]))
    of_root = F.lit(None).cast("string") if base.rsplit("/", 1)[-1].strip().lower() in GENERIC_FOLDERS else F.when(own != name, own)
    last = F.try_element_at(folders, F.lit(-1))
    below = F.when(last == name, F.slice(folders, 1, F.size(folders) - 1)).otherwise(folders)
    return F.when(F.size(folders) == 0, F.concat_ws("/", F.lit(out), of_root)).otherwise(F.concat_ws("/", F.lit(out), F.nullif(F.array_join(below, "/"), F.lit(""))))


def keyword_rows(sheet: DataFrame, number: str, prefix: str) -> DataFrame:
    """Wide to long: (file_no, keywords) with the values of the columns whose names start with ``prefix``, blanks dropped."""
    columns = [c for c in sheet.columns if c.startswith(prefix)]
    shown = [value_text(F.col(c), sheet.schema[c].dataType).alias(c) for c in columns]
    long = sheet.select(padded_number(F.col(number)).alias("file_no"), *shown).unpivot(["file_no"], columns, "position", "keyword")
    long = long.where(F.trim("keyword") != "")
    order = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)])
    entry = F.struct(order[F.col("position")].alias("i"), F.trim("keyword").alias("k"))
    return long.groupBy("file_no").agg(F.array_sort(F.collect_list(entry)).getField("k").alias("keywords"))


def find_inputs(wanted: DataFrame, files: DataFrame, root: str = "", suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """For each file_no its file, names being taken exactly as they are written.

    A file_no with a suffix is a file's name: that in the root, else the first further below, and nothing else. One without is a name to which a
    known suffix is put: in the root, else further below, by order of suffixes; else the first file whose name begins with it and a point. The
    first is that of the least path, folder by folder. ``root`` is the folder that paths start with.
    """
    base = root.rstrip("/") + "/" if root else ""
    below = F.substring(F.col("path"), len(base) + 1, 1 << 20)
    name = F.element_at(F.split("path", "/"), -1)
    begin = F.regexp_extract(name, r"^(.[^.]*)", 1)
    place = F.array_position(F.array(*map(F.lit, suffixes)), F.substring(name, F.char_length(begin) + 2, F.char_length(name)))
    listed = files.select("path", F.split("path", "/").alias("parts"), name.alias("name"), begin.alias("begin"), (~below.contains("/")).alias("direct"), place.alias("place"))

    def found(tier: Column, order: Column, key: str) -> DataFrame:
        best = F.min(F.struct(tier.alias("tier"), order.alias("place"), "parts", "path")).getField("path").alias("path")
        return listed.groupBy(F.col(key).alias("key")).agg(best)

    whole = found(F.when(F.col("direct"), 0).otherwise(1), F.lit(0), "name").withColumn("named", F.lit(True))
    known = F.when(F.col("place") == 0, 2).when(F.col("direct"), 0).otherwise(1)
    begun = found(known, F.col("place"), "begin").withColumn("named", F.lit(False))
    has_suffix = F.col("file_no").rlike(r"^.+\.[^.]+$")
    asked = wanted.withColumn("named", F.coalesce(has_suffix, F.lit(False))).withColumn("key", F.col("file_no"))
    return asked.join(whole.unionByName(begun), ["key", "named"], "left").select(*[F.col(f"`{c}`") for c in wanted.columns], "path")


def gpu_inventory(lines: DataFrame, column: str = "line") -> DataFrame:
    """(index, uuid, total_mib, used_mib, free_mib) of comma-separated lines; malformed ones are skipped."""
    parts = F.transform(F.split(column, ","), lambda x: F.trim(x))
    rows = lines.where(F.size(parts) >= 4).select(
        parts[0].try_cast("int").alias("index"), parts[1].alias("uuid"), parts[2].try_cast("int").alias("total_mib"), parts[3].try_cast("int").alias("used_mib"),
    )
    rows = rows.where("index is not null and uuid <> '' and total_mib is not null and used_mib is not null")
    return rows.withColumn("free_mib", F.greatest(F.lit(0), F.col("total_mib") - F.col("used_mib")))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A rules CSV, one row per sensitive word; ASCII and full-width commas separate words."""
    rules = spark.read.csv(path, header=True)
    return rules.select("row_id", "rule_id", "rule_tag", F.explode(F.split("sensitive_words", "[,，、]")).alias("word")).withColumn("word", F.trim("word")).where("word <> ''").distinct()


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A JSON report as one row per file."""
    return spark.read.json(path, multiLine=True)
