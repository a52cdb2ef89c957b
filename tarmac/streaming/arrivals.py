"""Feed newly arrived extractor files to the pipeline, once per scheduled run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tarmac.sources.raw import stamped, stream_documents
from tarmac.streaming.pipeline import Pipeline


def run_arrivals(pipeline: Pipeline, folder: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Process all files not seen yet, in batches, then stop.

    The stream's checkpoint remembers the files. A batch that broke off comes
    again with the same number, files and stamps, and applying it twice is
    the same as once.
    """
    deliveries = stamped(stream_documents(pipeline.spark, folder, files_per_batch))

    def merge(batch: DataFrame, number: int) -> None:
        pipeline.apply(batch, number)

    return (
        deliveries.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{pipeline.root}/_arrivals")
        .trigger(availableNow=True)
        .start()
    )
