"""Answers of a costly model: a content-addressed cache, and admission up to a budget. R9

A request is its fingerprint: a hash of the input, the prompt's name and version, the model and the schema of its output. Equal requests are asked once,
whoever makes them, and those that the cache answers are not asked at all: what is left is an anti-join, not a look-up for each row.

Of the open requests as many are admitted, in order of priority and fingerprint, as the budget pays for. There is no sort of all requests: costs are
summed by priority, then by the leading digits of the fingerprint of the priority that the budget ends in, then by further digits of that range, until
one range of few is left; a request is compared with the edge that this gives. The driver sees ``RANGES`` sums a level.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import checkpointed

#: Hexadecimal digits of a level, and so sums that the driver sees at a level.
DIGITS = 3
RANGES = 16**DIGITS


@dataclass(frozen=True)
class Model:
    """What an answer depends on besides its input, and the function that gives answers to a batch of inputs."""

    name: str
    version: str
    answer: Callable[[pd.Series], pd.Series]
    prompt: str = ""
    output_schema: str = ""


def fingerprint(text: Column, model: Model) -> Column:
    """SHA-256 of the input and all that its answer depends on; parts are told apart by their lengths."""
    parts = [F.lit(model.name), F.lit(model.version), F.lit(model.prompt), F.lit(model.output_schema), F.coalesce(text, F.lit(""))]
    return F.sha2(F.concat(*[F.concat(F.octet_length(p).cast("string"), F.lit(":"), p) for p in parts]), 256)


def open_requests(inputs: DataFrame, cache: DataFrame | None, model: Model, max_age_seconds: float | None = None) -> DataFrame:
    """(fingerprint, text, cost, priority): one row for each distinct request that the cache does not answer.

    ``inputs``: text, cost and, if there is one, priority (smaller goes first); of equal requests the greatest cost and the smallest priority count.
    Cached answers (fingerprint, answer, created_at) older than ``max_age_seconds`` do not count.
    """
    priority = F.col("priority") if "priority" in inputs.columns else F.lit(0)
    asked = inputs.select(fingerprint(F.col("text"), model).alias("fingerprint"), F.coalesce("text", F.lit("")).alias("text"), F.col("cost").cast("bigint").alias("cost"), priority.cast("int").alias("priority"))
    one = asked.groupBy("fingerprint").agg(F.any_value("text").alias("text"), F.max("cost").alias("cost"), F.min("priority").alias("priority"))
    return one if cache is None else one.join(fresh(cache, max_age_seconds).select("fingerprint"), "fingerprint", "left_anti")


def fresh(cache: DataFrame, max_age_seconds: float | None = None) -> DataFrame:
    """One answer for each fingerprint, the latest that is young enough."""
    young = cache if max_age_seconds is None else cache.where(F.col("created_at") >= F.current_timestamp() - F.make_dt_interval(secs=F.lit(float(max_age_seconds))))
    latest = F.max(F.struct("created_at", "answer"))
    return young.groupBy("fingerprint").agg(latest.getField("answer").alias("answer"))


def admitted(requests: DataFrame, budget: int) -> DataFrame:
    """The requests whose running cost, in order of priority and fingerprint, does not exceed the budget; the first that does not fit ends it."""
    costed = requests.where("cost IS NOT NULL AND cost >= 0")
    sums = sorted((r.priority, r.total) for r in costed.groupBy("priority").agg(F.sum("cost").alias("total")).collect())
    spent, edge = 0, None
    for priority, total in sums:
        if spent + total > budget:
            edge = priority
            break
        spent += total
    if edge is None:
        return costed
    known, at = "", costed.where(F.col("priority") == edge)
    while len(known) < 64:
        step = at.where(F.col("fingerprint").startswith(known)) if known else at
        digits = F.substring("fingerprint", len(known) + 1, min(DIGITS, 64 - len(known)))
        ranges = sorted((r.d, r.total, r.n) for r in step.groupBy(digits.alias("d")).agg(F.sum("cost").alias("total"), F.count("*").alias("n")).collect())
        over = None
        for d, total, n in ranges:
            if spent + total > budget:
                over = (d, n)
                break
            spent += total
        if over is None:  # cannot be: the range as a whole does not fit
            break
        known += over[0]
        if over[1] == 1:
            break
    # everything before the range in which the budget ends
    return costed.where((F.col("priority") < edge) | ((F.col("priority") == edge) & (F.substring("fingerprint", 1, len(known)) < known)))


def answered(requests: DataFrame, model: Model) -> DataFrame:
    """(fingerprint, answer, created_at) of requests, asked in Arrow batches."""
    ask = F.pandas_udf(model.answer, "string")
    return requests.select("fingerprint", ask("text").alias("answer"), F.current_timestamp().alias("created_at"))


def serve(inputs: DataFrame, cache: DataFrame | None, model: Model, budget: int, max_age_seconds: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, added): ``inputs`` with (fingerprint, answer, origin) and what the cache is to be given.

    The origin is ``cache``, ``model``, or ``deferred`` for requests beyond the budget, which have no answer. Answers of the model are written before they are used, so that
    a lost task does not ask again what was answered.
    """
    added = checkpointed(answered(admitted(checkpointed(open_requests(inputs, cache, model, max_age_seconds)), budget), model))
    new = added.select("fingerprint", "answer", F.lit("model").alias("origin"))
    known = new if cache is None else fresh(cache, max_age_seconds).withColumn("origin", F.lit("cache")).unionByName(new)
    keyed = inputs.withColumn("fingerprint", fingerprint(F.col("text"), model))
    rows = keyed.join(known, "fingerprint", "left").withColumn("origin", F.coalesce("origin", F.lit("deferred")))
    return rows, added
