"""Batch reports, resumption, benchmark trials and device choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import checkpointed

#: Entries of a list of limits.
MOST_LIMITS = 10_000
# The columns of the batch CSV, in order.
BATCH_COLUMNS = (
    "pdf_path", "success", "skipped", "json_path", "error_report", "error_type", "error_code", "error", "elapsed_seconds", "processing_seconds",
    "queue_wait_seconds", "wall_elapsed_seconds", "page_count", "text_block_count", "table_block_count", "table_cell_count", "table_engine",
    "paddle_table_mode", "input_type", "relative_input_path", "output_relative_dir", "converted_pdf_path", "page_screenshots_manifest", "field_keywords",
    "field_match_count", "field_coordinates_path", "field_annotation_pdf_path",
)


def batch_rows(results: DataFrame) -> DataFrame:
    """K4: results with exactly the columns of the batch CSV, in their order, as texts; what results lack is null, lists are JSON."""

    def shown(name: str) -> Column:
        if name not in results.columns:
            return F.lit(None).cast("string").alias(name)
        kind = results.schema[name].dataType.typeName()
        return (F.to_json(name) if kind in ("array", "map", "struct") else F.col(name).cast("string")).alias(name)

    return results.select(*[shown(c) for c in BATCH_COLUMNS])


def per_page(elapsed: Column, pages: Column) -> Column:
    """A2: seconds a page to three decimals, 0 without pages."""
    return F.when(pages > 0, F.round(elapsed / pages, 3)).otherwise(F.lit(0.0))


def batch_report(results: DataFrame, *keys: str) -> DataFrame:
    """A1, K3: files, successes, failures, skipped, pages and matches of successes, seconds; pre-aggregated."""
    ok = F.col("success")
    totals = results.groupBy(*keys).agg(
        F.count("*").alias("total_files"), F.count_if(ok).alias("success_count"), F.count_if(~ok).alias("failure_count"), F.count_if(ok & F.col("skipped")).alias("skipped_count"),
        F.coalesce(F.sum(F.when(ok, F.col("pages"))), F.lit(0)).alias("total_pages"), F.coalesce(F.sum(F.when(ok, F.col("matches"))), F.lit(0)).alias("total_matches"),
        F.round(F.sum("elapsed"), 3).alias("elapsed_seconds"),
    )
    return totals.withColumn("seconds_per_page", per_page(F.col("elapsed_seconds"), F.col("total_pages")))


def failures(results: DataFrame) -> DataFrame:
    """K5"""
    return results.where(~F.coalesce("success", F.lit(False)))


def write_batch(results: DataFrame, path: str) -> None:
    """K3, K4, K5: report, CSV and failures below a folder."""
    batch_report(results).coalesce(1).write.mode("overwrite").json(f"{path}/report")
    batch_rows(results).write.mode("overwrite").csv(f"{path}/batch", header=True)
    failures(results).write.mode("overwrite").json(f"{path}/failed")


def pending(tasks: DataFrame, done: DataFrame, *keys: str, same: tuple[str, ...] = ()) -> DataFrame:
    """Tasks without an earlier result of the same key; with ``same``, one that agrees in those columns too."""
    on = None
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"d.{k}")
        on = c if on is None else on & c
    for k in same:
        on = on & F.col(f"t.{k}").eqNullSafe(F.col(f"d.{k}"))
    usable = done.where("success") if "success" in done.columns else done
    return tasks.alias("t").join(usable.alias("d"), on, "left_anti")


def reusable(results: DataFrame, tasks: DataFrame, files: DataFrame, key: str = "doc_id") -> DataFrame:
    """Earlier results that a task can take over, with their counts.

    The result's JSON is readable and has a list of pages; if the task asks for keywords, they are those of the result, and its
    coordinates and its annotated file are still there. ``results``: key, json, field_keywords, field_coordinates_path,
    field_annotation_pdf_path; ``tasks``: key, field_keywords; ``files``: path.
    """
    items = lambda v, path: F.try_variant_get(v, f"$.{path}", "array<variant>")
    count = lambda v, path: F.greatest(F.lit(0), F.coalesce(F.size(items(v, path)), F.lit(0)))
    total = lambda of: F.aggregate(of, F.lit(0), lambda a, x: a + x)
    none = F.array().cast("array<string>")
    read = results.withColumn("_pages", items(F.try_parse_json("json"), "pages")).where("_pages is not null")
    asked = tasks.select(key, F.coalesce("field_keywords", none).alias("_asked"))
    there = files.select("path").distinct()
    both = read.join(asked, key)
    for column in ("field_coordinates_path", "field_annotation_pdf_path"):
        both = both.join(there.select(F.col("path").alias(column), F.lit(True).alias(f"_{column}")), column, "left")
    same = (F.coalesce("field_keywords", none) == F.col("_asked")) & F.coalesce("_field_coordinates_path", F.lit(False)) & F.coalesce("_field_annotation_pdf_path", F.lit(False))
    tables = F.flatten(F.transform("_pages", lambda p: F.coalesce(items(p, "table_blocks"), F.array().cast("array<variant>"))))
    return both.where((F.size("_asked") == 0) | same).select(
        key, F.lit(True).alias("success"), F.lit(True).alias("skipped"), F.size("_pages").alias("page_count"), total(F.transform("_pages", lambda p: count(p, "text_blocks"))).alias("text_block_count"),
        F.size(tables).alias("table_block_count"), total(F.transform(tables, lambda t: count(t, "cells"))).alias("table_cell_count"),
    )


def trial_status(code: Column, readable: Column, failed: Column, succeeded: Column) -> Column:
    """success if the trial ended well, with a readable report, at least one success and no failure; else failed."""
    good = (code == 0) & readable & (F.coalesce(failed, F.lit(0)) <= 0) & (F.coalesce(succeeded, F.lit(0)) > 0)
    return F.when(F.coalesce(good, F.lit(False)), F.lit("success")).otherwise(F.lit("failed"))


def best_trials(trials: DataFrame, *keys: str) -> DataFrame:
    """The successful trial of least time per key, then of least seconds a page; a minimum, not a sort."""
    body = [c for c in trials.columns if c not in keys]
    order = F.struct("elapsed", "seconds_per_page", *[c for c in body if c not in ("elapsed", "seconds_per_page")])
    best = trials.where("success").groupBy(*keys).agg(F.min(order).alias("b"))
    return best.select(*keys, *[f"b.{c}" for c in body])


def workbook(trials: DataFrame, key: str) -> DataFrame:
    """The rows of a benchmark's sheets: every key's best trial in the sheet ``summary``, and all trials of a key, in order of time, in a sheet of its name."""
    best = best_trials(trials, key).withColumn("sheet", F.lit("summary"))
    body = [c for c in trials.columns if c != key]
    every = trials.withColumn("sheet", F.lower(F.col(key).cast("string"))).select("sheet", key, *body).unionByName(best.select("sheet", key, *body))
    place = F.row_number().over(Window.partitionBy("sheet").orderBy("elapsed", "seconds_per_page", key, *[c for c in body if c not in ("elapsed", "seconds_per_page")]))
    return every.select("sheet", place.alias("place"), key, *body)


def save_state(trials: DataFrame, path: str) -> str:
    """A benchmark's state, whole or not at all: written under a new name, which the file ``current`` then takes over in one rename; returns the name."""
    import uuid

    spark, name = trials.sparkSession, uuid.uuid4().hex
    trials.write.parquet(f"{path}/{name}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    new, current = hadoop.Path(f"{path}/{name}.current"), hadoop.Path(f"{path}/current")
    files = current.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(new, True)
    out.write(bytearray(name, "ascii"))
    out.close()
    if files.exists(current):
        files.delete(current, False)
    files.rename(new, current)
    return name


def load_state(spark, path: str) -> DataFrame:
    """The state that was saved last."""
    name = spark.read.text(f"{path}/current").first()[0]
    return spark.read.parquet(f"{path}/{name}")


def has_failure(trials: DataFrame, *keys: str) -> DataFrame:
    """F16: distinct keys with a failed trial."""
    return trials.where(~F.col("success")).select(*keys).distinct()


def open_values(planned: DataFrame, trials: DataFrame, key: str, value: str) -> DataFrame:
    """planned values not yet tried, up to and without the first whose lesser or equal value failed."""
    limit = trials.where(~F.col("success")).groupBy(key).agg(F.min(value).alias("stop"))
    done = trials.select(key, value).distinct()
    left = planned.join(done, [key, value], "left_anti").join(limit, key, "left")
    return left.where(F.col("stop").isNull() | (F.col(value) < F.col("stop"))).drop("stop")


def limit_grid(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pair of two lists of limits, the right one of at most ``MOST_LIMITS``; each row of the left is paired with all of the list."""
    rows = right.limit(MOST_LIMITS + 1).collect()
    if len(rows) > MOST_LIMITS:
        raise ValueError(f"more than {MOST_LIMITS} limits")
    limits = F.array(*[F.struct(*[F.lit(v).cast(right.schema[c].dataType).alias(c) for c, v in r.asDict().items()]) for r in rows])
    return left.select("*", F.explode(limits).alias("_limit")).select(*left.columns, "_limit.*") if rows else left.crossJoin(right)


def visible(devices: DataFrame, setting: str | None) -> DataFrame:
    """Devices named by a setting (indexes or uuids, comma-separated), renumbered in its order; all if it is unset."""
    if setting is None:
        return devices.withColumn("visible_index", F.col("index"))
    tokens = [t.strip().lower() for t in setting.split(",") if t.strip()]
    wanted = devices.sparkSession.createDataFrame(list(enumerate(tokens)), "visible_index int, token string")
    named = (F.col("token") == F.col("index").cast("string")) | (F.col("token") == F.lower("uuid"))
    return devices.join(F.broadcast(wanted), named).drop("token")


def rank_devices(devices: DataFrame, processes: DataFrame, top: int = 1) -> DataFrame:
    """The devices of most free memory, then fewest processes, then least index."""
    running = processes.groupBy("uuid").agg(F.count("*").alias("n_processes"))
    known = devices.join(running, "uuid", "left").withColumn("n_processes", F.coalesce("n_processes", F.lit(0)))
    return known.orderBy(F.col("free_mib").desc(), "n_processes", "index").limit(top)


def document_rollup(pages: DataFrame) -> DataFrame:
    """Pages per document, their numbers, block totals and facts of the first page."""
    return pages.groupBy("doc_id").agg(
        F.count("*").alias("parsed_pages"), F.array_sort(F.collect_set("page_index")).alias("page_numbers"), F.sum("n_blocks").alias("n_blocks"),
        F.min_by("width", "page_index").alias("first_width"),
    )


def chunks(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Rows numbered in order of a unique key, ``size`` to a chunk.

    Ranges are sorted and counted first, and each row's number is its place in its range after the ranges before it, so no
    task sees more than a range.
    """
    dealt = checkpointed(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = {r["_range"]: r["count"] for r in dealt.groupBy("_range").count().collect()}  # a row per range, not per row
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    start = F.element_at(F.array(*map(F.lit, before)), F.col("_range") + 1) if before else F.lit(0)
    n = start + F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return dealt.withColumn("chunk", F.floor(n / size).cast("int")).drop("_range")
