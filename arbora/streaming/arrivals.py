"""Arriving review lines parsed as a stream: the row patterns are stateless, so the batch operator is
used as it is. Lines delivered again within the watermark are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from arbora.operators.rowparse import entry_lines

SCHEMA = "line_id bigint, file_name string, line_no bigint, raw_line string, received_at timestamp_ntz"


def parsed(spark: SparkSession, folder: str, late: str = "1 day") -> DataFrame:
    lines = spark.readStream.schema(SCHEMA).parquet(folder).selectExpr("line_id", "file_name", "line_no", "raw_line", "cast(received_at as timestamp) as received_at")
    return entry_lines(lines.withWatermark("received_at", late).dropDuplicatesWithinWatermark(["line_id"]))


def rejected_to(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Writes (line_id, reason, received_at) of broken lines as they arrive."""
    bad = parsed(spark, folder).where("reason is not null").select("line_id", "reason", "received_at")
    return bad.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
