"""Keeps the daily-sales table in step with the fact table.

The host of a materialized view refreshes it by itself; here a file stream
over the fact table does.  Each micro-batch adds the sums of its new files to
the states of their days, and a state knows the files that it has counted.  A
batch that runs again after a failure therefore changes nothing, and late rows
for an old day are handled like any others, without a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cardamom.plans.daily_table import merge_files, with_file


def _writer(spark, fact_path, checkpoint, each, max_files_per_batch=None):
    reader = spark.readStream.schema(spark.read.parquet(fact_path).schema)
    reader = reader.option("ignoreMissingFiles", "true")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    rows = with_file(reader.parquet(fact_path))
    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


def start_after(spark: SparkSession, fact_path: str, checkpoint: str) -> None:
    """Note the fact's present files as seen, without reading them.

    Call it right before ``build_daily_table``: the build reads all of these
    files, and ``follow_fact_table`` with the same checkpoint starts from the
    files that come later.  Without it the first batch reads all files once
    more, and adds nothing.
    """
    nothing = lambda batch, _: None
    _writer(spark, fact_path, checkpoint, nothing).trigger(availableNow=True).start().awaitTermination()


def follow_fact_table(
    spark: SparkSession,
    fact_path: str,
    table_path: str,
    checkpoint: str,
    max_files_per_batch: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Start the upkeep; without ``interval`` it stops once it has caught up.

    After a rewrite of the fact call ``refresh_daily_table`` with the partitions
    it touched, before the stream goes on: the recomputed states know the new
    files, so the stream adds them no second time.  Files that the stream has
    listed but a rewrite has removed are passed over.
    """

    def merge(batch: DataFrame, _: int) -> None:
        merge_files(batch.sparkSession, table_path, batch)

    writer = _writer(spark, fact_path, checkpoint, merge, max_files_per_batch)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()
