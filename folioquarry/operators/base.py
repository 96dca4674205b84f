"""User operators: a row or a batch function with declared schemas, a registry, error rows and metrics.

Spark plans and schedules; an operator only says what happens to a row (``RowOperator``, none, one or
many rows back) or to an Arrow batch (``ArrowOperator``). An error of one row becomes a row of the error column, so that a
bad document does not end a job; retryable errors are tried again in place.
"""

from __future__ import annotations

import ctypes
import gc
import signal
import tempfile
import threading
import time
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, suppress
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Sizes of batches for Python, where the session does not say otherwise.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
#: Rows that an operator gives at once.
ROWS_OUT = 256
ERROR = StructType([StructField("code", StringType()), StructField("message", StringType()), StructField("retryable", StringType())])


class OperatorError(Exception):
    """An error with a code, and whether trying again may help."""

    def __init__(self, message: str, code: str = "OPERATOR_ERROR", retryable: bool = False, details: dict[str, Any] | None = None) -> None:
        super().__init__(message)
        self.code, self.retryable, self.details = code, retryable, details or {}


@dataclass(frozen=True)
class Retry:
    attempts: int = 3
    wait_seconds: float = 0.5
    factor: float = 2.0


@dataclass(frozen=True)
class Context:
    """Ids that a run passes to its operators; plain values, captured by the closure."""

    trace_id: str = ""
    run_id: str = ""
    config_version: str = ""
    tags: dict[str, str] = field(default_factory=dict)


def _schema(kind: str | StructType) -> StructType:
    return kind if isinstance(kind, StructType) else StructType.fromDDL(kind)


@contextmanager
def deadline(seconds: float | None) -> Iterator[None]:
    """An ``OperatorError`` of code TIMEOUT, worth trying again, once the block has run for so long. None, or a thread that is not the main one, has no deadline."""
    if seconds is None or threading.current_thread() is not threading.main_thread():
        yield
        return

    def late(*_: Any) -> None:
        raise OperatorError(f"took more than {seconds} seconds", code="TIMEOUT", retryable=True)

    before = signal.signal(signal.SIGALRM, late)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


class Hooks:
    """What a task calls around the rows of an operator; subclasses do what they want with it. An error in a hook ends the task."""

    def started(self, context: Context) -> None: ...

    def ended(self, context: Context, rows: int) -> None: ...

    def failed(self, context: Context, error: Exception) -> None: ...


class _Configured:
    """Operators are built from a mapping of their options, and tell which path they take."""

    @classmethod
    def from_config(cls, config: dict[str, Any] | None = None):
        try:
            return cls(**(config or {}))
        except TypeError as e:
            raise OperatorError(f"{cls.__name__}: {e}", code="INVALID_OPERATOR_OPTION", details=dict(config or {})) from e

    @classmethod
    def works_by(cls) -> str:
        return "batch" if hasattr(cls, "process_batch") else "row"


def in_batches(df: DataFrame, work: Callable[[Iterator], Iterator], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow(work, schema)`` in batches of few megabytes, so that what a worker holds does not grow with the rows; at its end a task gives memory back to the system."""
    conf = df.sparkSession.conf
    for key, value in BATCHES.items():
        if conf.get(key, None) is None:
            conf.set(key, value)

    def run(batches):
        import pyarrow as pa

        pa.set_memory_pool(pa.system_memory_pool())  # one that can be trimmed
        try:
            yield from work(batches)
        finally:
            gc.collect()
            with suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return df.mapInArrow(run, schema)


class RowOperator(_Configured):
    """``fn(context, row)`` gives None, a dict or several; ``output`` is their schema. Further columns of the input are not kept.

    ``input_types`` (DDL) has the types that columns must have; ``timeout_seconds`` is what a row may take; ``hooks`` are called by each task.
    """

    name, version = "row", "1"
    input_columns: tuple[str, ...] = ()
    input_types: str | None = None
    output: str | StructType = ""
    retry = Retry(attempts=1)
    timeout_seconds: float | None = None
    hooks: Hooks = Hooks()

    def process_row(self, context: Context, row: dict[str, Any]) -> dict[str, Any] | Iterable[dict[str, Any]] | None:
        raise NotImplementedError

    def transform(self, df: DataFrame, context: Context = Context(), *, errors: bool = False) -> DataFrame:
        """The output rows; with ``errors`` a struct column ``error`` is set on a row per failed input, else errors are raised."""
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        check_columns(df, self.input_columns, self.input_types)
        schema = _schema(self.output)
        if errors:
            schema = StructType([*schema.fields, StructField("error", ERROR)])
        arrow = to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done = 0
            self.hooks.started(context)
            for batch in batches:
                out: list[dict[str, Any]] = []
                for row in batch.to_pylist():
                    for r in self._rows(context, row, errors):
                        out.append(r)
                        if len(out) == ROWS_OUT:
                            yield pa.RecordBatch.from_pylist(out, schema=arrow)
                            out = []
                done += batch.num_rows
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
            self.hooks.ended(context, done)

        return in_batches(df, run, schema)

    def _rows(self, context: Context, row: dict[str, Any], errors: bool) -> list[dict[str, Any]]:
        wait = self.retry.wait_seconds
        for attempt in range(1, self.retry.attempts + 1):
            try:
                with deadline(self.timeout_seconds):
                    found = self.process_row(context, row)
                return [] if found is None else [found] if isinstance(found, dict) else list(found)
            except OperatorError as e:
                if e.retryable and attempt < self.retry.attempts:
                    time.sleep(wait)
                    wait *= self.retry.factor
                    continue
                self.hooks.failed(context, e)
                if not errors:
                    raise
                return [{**{c: row.get(c) for c in self.input_columns}, "error": {"code": e.code, "message": str(e), "retryable": str(e.retryable).lower()}}]
            except Exception as e:
                self.hooks.failed(context, e)
                if not errors:
                    raise
                return [{**{c: row.get(c) for c in self.input_columns}, "error": {"code": "UNEXPECTED", "message": f"{type(e).__name__}: {e}", "retryable": "false"}}]
        return []


class ArrowOperator(_Configured):
    """``process_batch(context, batch)`` gives a batch of the ``output`` schema, or of the input's where that is unset."""

    name, version = "arrow", "1"
    input_columns: tuple[str, ...] = ()
    output: str | StructType | None = None

    def process_batch(self, context: Context, batch):
        raise NotImplementedError

    def transform(self, df: DataFrame, context: Context = Context()) -> DataFrame:
        check_columns(df, self.input_columns)
        work = self.process_batch
        return in_batches(df, lambda batches: (work(context, b) for b in batches), _schema(self.output) if self.output else df.schema)


def check_columns(df: DataFrame, needed: Iterable[str], types: str | None = None) -> None:
    """Fails before anything runs if a column is missing or of another type than declared (DDL)."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise OperatorError(f"input lacks {missing}", code="SCHEMA_MISMATCH")
    for f in _schema(types).fields if types else []:
        if f.name not in df.columns or df.schema[f.name].dataType != f.dataType:
            raise OperatorError(f"{f.name} must be {f.dataType.simpleString()}", code="SCHEMA_MISMATCH")


def arrow_batches(rows: Iterable[dict[str, Any]], schema: str | StructType, size: int = 1024) -> Iterator:
    """Rows as Arrow batches of at most ``size``."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    if size <= 0:
        raise OperatorError("batch size must be positive", code="INVALID_OPERATOR_OPTION")
    kind, some = to_arrow_schema(_schema(schema)), []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield pa.RecordBatch.from_pylist(some, schema=kind)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema=kind)


def rows_of(batches: Iterable) -> Iterator[dict[str, Any]]:
    """The rows of Arrow batches."""
    for batch in batches:
        yield from batch.to_pylist()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once in the shared checkpoint folder: rows keep what tasks have dealt them, whatever runs again.

    A temporary folder is used only where ``spark.checkpoint.dir`` is unset and the master is local.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        found = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not found and not context.master.startswith("local"):
            raise OperatorError("set spark.checkpoint.dir to a folder that all executors share", code="NO_CHECKPOINT_DIR")
        context.setCheckpointDir(found or "file://" + tempfile.mkdtemp(prefix="folioquarry-"))
    return df.checkpoint()


_registry: dict[tuple[str, str], type] = {}


def register(cls: type) -> type:
    """Class decorator; the operator can then be had by name and version."""
    _registry[cls.name, cls.version] = cls
    return cls


def get_operator(name: str, version: str = "1") -> type:
    found = _registry.get((name, version))
    if found is None:
        raise KeyError(f"no operator {name} {version}")
    return found


def observed(df: DataFrame, name: str) -> DataFrame:
    """``df``; when it is read, row and error counts are reported under ``name`` as observed metrics."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    if "error" in df.columns:
        metrics.append(F.count("error").alias("errors"))
    return df.observe(name, *metrics)


@register
class Uppercase(ArrowOperator):
    """The column ``text`` in upper case, batch by batch."""

    name = "uppercase"
    input_columns = ("text",)

    def process_batch(self, context: Context, batch):
        import pyarrow.compute as pc

        at = batch.schema.get_field_index("text")
        return batch.set_column(at, batch.schema.field(at), pc.utf8_upper(batch.column(at)))


@register
class NormalizeText(RowOperator):
    """P5 as a row operator: (doc_id, text) with ``plain_words`` of the text; what is no text counts as empty."""

    name = "normalize_text"
    input_columns = ("doc_id", "text")
    output = "doc_id bigint, text string"

    def process_row(self, context: Context, row: dict[str, Any]) -> dict[str, Any]:
        from ..functions.text import plain_words

        return row | {"text": plain_words(row["text"] if isinstance(row["text"], str) else "")}


Extractor = Callable[[bytes | str, dict[str, Any]], list[dict[str, Any]]]
