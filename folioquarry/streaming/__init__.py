"""Documents as they arrive: a file stream, extracted and searched like a batch.

Every step but the deduplication of matches is a map, so the same plans run on a stream; a batch's
matches are deduplicated inside ``foreachBatch``, and a document arrives whole in one batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import search
from ..sources import layout_text as L


def arrivals(spark: SparkSession, path: str, schema: str | StructType, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files of documents as they land in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def search_stream(docs: DataFrame, keywords: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes the matches of arriving documents to ``out``, exactly once: a batch's folder is replaced if it is tried again."""

    def write(batch: DataFrame, number: int) -> None:
        found = search.field_search(L.blocks(batch), L.cells(batch), keywords)
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
