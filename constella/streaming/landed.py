"""Incremental runs driven by Structured Streaming over landed page files.

``readStream`` of the landing folder with the declared envelope schema ->
``foreachBatch`` with ``trigger(availableNow=True)``.  The stream's checkpoint
says which files Spark hands over; the warehouse's ledger of landed pages says
which of their pages are new.  So a micro-batch that is replayed, or a stream
that has lost its checkpoint, finds its pages in the ledger and writes
nothing, and the daily run over the same folder agrees with both.  Pages that
can't be read are kept with their text, and the stream goes on.  Note: the
file source never re-reads a file name it has seen -- re-land an open (partly
filled) page under a new name, or leave it to the daily run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from constella.plans.pipeline import RunOptions, load_pages
from constella.session import scratch
from constella.sources.pages import envelope_schema, pages_of
from constella.sources.tables import Warehouse


def landed_stream(spark: SparkSession, landing: str, multiline: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The landed pages as a stream, with the file that each is from."""
    reader = (spark.readStream.schema(envelope_schema())
                   .option("mode", "PERMISSIVE")
                   .option("columnNameOfCorruptRecord", "_corrupt_record")
                   .option("multiLine", multiline))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return pages_of(reader.json(landing))


def run_stream(wh: Warehouse, landing: str, checkpoint: str | None = None,
               options: RunOptions = RunOptions(), multiline: bool = False,
               max_files_per_trigger: int | None = None, wait: bool = True, limit: int = 50) -> StreamingQuery:
    """Process every page file landed so far, then stop (``availableNow``).  ``limit``, the page size, moves the page
    mark, which the daily run goes on from."""
    spark = wh.spark
    checkpoint = checkpoint or wh.stream_checkpoint()

    def each(batch: DataFrame, epoch_id: int) -> None:
        with scratch(spark):
            load_pages(wh, batch, limit, options, source="stream")

    q = (landed_stream(spark, landing, multiline, max_files_per_trigger)
         .writeStream.trigger(availableNow=True)
         .option("checkpointLocation", checkpoint)
         .foreachBatch(each)
         .start())
    if wait:
        q.awaitTermination()
    return q
