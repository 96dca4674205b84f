"""Extraction of pages from documents by a pluggable parser, with error rows, retries and sinks."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .base import Context, Extractor, OperatorError, Retry, RowOperator, register

PAGE_ROWS = (
    "doc_id bigint, page_index int, text string, blocks array<struct<line_no: int, text: string, box: struct<x: int, y: int, w: int, h: int>>>"
)


def plain_text_parser(content: bytes | str, options: dict[str, Any]) -> list[dict[str, Any]]:
    """A parser without a model: pages of ``lines_a_page`` lines, every line that is not blank a block."""
    text = content.decode("utf-8") if isinstance(content, bytes) else content
    per = int(options.get("lines_a_page", 40))
    lines = text.split("\n")
    pages = []
    for start in range(0, len(lines), per):
        blocks = [
            {"line_no": start + i, "text": line, "box": {"x": 10, "y": i * 20, "w": 8 * len(line), "h": 16}}
            for i, line in enumerate(lines[start : start + per]) if line.strip()
        ]
        pages.append({"page_index": start // per, "text": "\n".join(b["text"] for b in blocks) or None, "blocks": blocks})
    return pages


PARSERS: dict[str, Extractor] = {"plain_text": plain_text_parser}
#: Page rows of parsers that have a schema of their own, by name.
SCHEMAS: dict[str, str] = {}


def register_parser(name: str, parser: Extractor, schema: str = PAGE_ROWS) -> None:
    """A parser by name, with the schema (DDL) of the rows that it gives, doc_id first. Its module must be importable by the workers."""
    if not schema.replace(" ", "").startswith("doc_idbigint"):
        raise OperatorError("a parser's schema begins with doc_id bigint", code="INVALID_OPERATOR_OPTION")
    PARSERS[name], SCHEMAS[name] = parser, schema


@register
class ExtractPages(RowOperator):
    """(doc_id, text) to page rows. The parser is a plain function, found by name on the worker."""

    name = "extract_pages"
    input_columns = ("doc_id", "text")
    output = PAGE_ROWS
    retry = Retry(attempts=3)

    def __init__(self, parser: str = "plain_text", options: dict[str, Any] | None = None) -> None:
        if parser not in PARSERS:
            raise OperatorError(f"no parser {parser}", code="INVALID_OPERATOR_OPTION")
        self.parser, self.options = parser, dict(options or {})
        self.parse, self.output = PARSERS[parser], SCHEMAS.get(parser, PAGE_ROWS)

    def process_row(self, context: Context, row: dict[str, Any]):
        if not isinstance(row["text"], str) or not row["text"].strip():
            raise OperatorError("document has no content", code="EMPTY_DOCUMENT")
        return [{"doc_id": row["doc_id"], **page} for page in self.parse(row["text"], self.options)]


def extract(docs: DataFrame, parser: str = "plain_text", options: dict[str, Any] | None = None, partitions: int | None = None) -> DataFrame:
    """Page rows with an ``error`` struct on documents that failed. ``partitions`` is the concurrency, where a parser needs one."""
    if partitions is not None and (isinstance(partitions, bool) or partitions < 1):  # V12
        raise OperatorError("concurrency must be a positive number", code="INVALID_OPERATOR_OPTION")
    rows = docs.select("doc_id", "text")
    rows = rows.repartition(partitions) if partitions else rows
    return ExtractPages(parser, options).transform(rows, errors=True)


def file_results(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """A3, K2: one row per document: success, error code, pages and blocks; documents without a row are failures too."""
    own = pages.groupBy("doc_id").agg(
        F.count("page_index").alias("pages"), F.coalesce(F.sum(F.when(F.col("blocks").isNotNull(), F.size("blocks"))), F.lit(0)).alias("n_blocks"), F.max("error.code").alias("error_code"),
    )
    every = docs.select("doc_id").join(own, "doc_id", "left")
    return every.select("doc_id", (F.col("error_code").isNull() & (F.col("pages") > 0)).alias("success"), "error_code", F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"))


def failure_records(pages: DataFrame, context: Context = Context(), options: Column | None = None) -> DataFrame:
    """K6: records of failed documents, with secret options hidden."""
    hidden = T.redact(options) if options is not None else F.lit(None).cast("map<string,string>")
    return pages.where("error is not null").select(
        F.lit(1).alias("schema_version"), F.current_timestamp().alias("created_at"), F.lit(context.trace_id).alias("trace_id"), F.lit(context.run_id).alias("run_id"),
        "doc_id", "error", hidden.alias("options"),
    )


def with_defaults(meta: Column, defaults: dict[str, str]) -> Column:
    """A map with missing keys added; what is there stays."""
    given = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv])
    return F.map_concat(F.map_filter(given, lambda k, v: ~F.map_contains_key(F.coalesce(meta, F.create_map().cast("map<string,string>")), k)), F.coalesce(meta, F.create_map().cast("map<string,string>")))


def write_results(pages: DataFrame, path: str) -> None:
    """One folder of JSON per page number range; documents are not gathered."""
    pages.where("error is null").drop("error").write.mode("overwrite").json(f"{path}/pages")
    pages.where("error is not null").select("doc_id", "error").write.mode("overwrite").json(f"{path}/errors")
