"""Report files, message sets and plain append tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_report(df: DataFrame, folder: str, entity: str = "Entity") -> None:
    """Report as CSV with header, one folder per company."""
    even = df.hint("rebalance", entity)
    even.write.mode("overwrite").partitionBy(entity).option("header", True).option(
        "escape", '"'
    ).csv(folder)


def outbox(messages: DataFrame, endpoint: str | None = None) -> DataFrame:
    """Messages as outbox rows: message_id, endpoint, payload."""
    place = F.col("endpoint") if endpoint is None else F.lit(endpoint)
    return messages.select("message_id", place.alias("endpoint"), "payload")


def append_rows(df: DataFrame, folder: str, partition: str | None = None) -> None:
    """Append to a Parquet folder: run log, relation log, snapshots, outbox."""
    writer = df.write.mode("append")
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(folder)


def append_snapshot(df: DataFrame, folder: str, stamp: str = "snapshot_ts") -> None:
    """Append a stamped pull, stored by snapshot day."""
    append_rows(df.withColumn("snapshot_day", F.to_date(stamp)), folder, "snapshot_day")
