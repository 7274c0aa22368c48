"""Streaming: documents that arrive as files become pages batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quire.plans.publish import Options, build_pages
from quire.schemas import PARAGRAPHS


def read_paragraph_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of whole documents' paragraphs as a stream."""
    return spark.readStream.schema(PARAGRAPHS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_pages(paragraphs: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], options: Options = Options(), once: bool = False) -> StreamingQuery:
    """Build pages of each arriving batch and hand them to `sink` with the batch's number.

    A document must arrive within one file, as a page's extent depends on the whole of it. A sink that overwrites by batch
    number gives every page exactly once, as a repeated batch has the same number and content.
    """

    def run(batch: DataFrame, number: int) -> None:
        sink(build_pages(batch, options), number)

    writer = paragraphs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return (writer.trigger(availableNow=True) if once else writer).start()
