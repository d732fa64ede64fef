"""Fused contract checks per micro-batch, and running counters over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import checks
from tidemark.operators.checks import TableRules


def check_stream(stream: DataFrame, rules: TableRules, output_path: str, checkpoint_location: str,
                 available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Run the table's checks on every micro-batch; append the check rows
    (plus ``batch_id``) under ``output_path``, one partition per batch."""

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = checks.table_checks(batch, rules).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(output_path))

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def stream_counters(stream: DataFrame, rules: TableRules) -> DataFrame:
    """Running totals of the table's counters over the whole stream (a
    streaming aggregation; use output mode ``complete`` or ``update``)."""
    return checks.table_counters(stream, rules)
