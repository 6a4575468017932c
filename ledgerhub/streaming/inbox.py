"""Inbound XML messages: good ones to a table, malformed ones to a dead-letter table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerhub.functions.text import quoted
from ledgerhub.functions.xml import parsed


def read_messages(messages: DataFrame, ddl: str) -> DataFrame:
    """Messages with their parsed form."""
    return messages.withColumn("message", parsed(F.col("value"), ddl))


def split_messages(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed messages, and those that are not well-formed."""
    bad = F.col("message").isNull() | F.col("message._corrupt_record").isNotNull()
    good = read.where(~bad).select("message.*").drop("_corrupt_record")
    return good, read.where(bad).select(F.col("value").alias("payload"))


def _told_once(messages: DataFrame, ddl: str, unique: Sequence[str], kept: str) -> DataFrame:
    """Parsed messages without those whose ``unique`` fields landed before, within ``kept``.

    A message that is not well-formed, or lacks such a field, is told by its whole text. Its time is that of
    its landing, so none is ever late and state is dropped as new files land.
    """
    read = read_messages(messages, ddl)
    parts = [F.col(f"message.{c}").cast("string") for c in quoted(unique)]
    whole = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts], F.col("message._corrupt_record").isNull())
    told = F.when(F.coalesce(whole, F.lit(False)), F.to_json(F.array(*parts))).otherwise(F.concat(F.lit("text "), "value"))
    keyed = read.withColumn("_told", told).withWatermark("landed_at", kept)
    return keyed.dropDuplicatesWithinWatermark(["_told"]).drop("_told", "landed_at")


def inbox_stream(
    spark: SparkSession,
    landing: str,
    ddl: str,
    good_folder: str,
    bad_folder: str,
    checkpoint: str,
    one_per_file: bool = True,
    unique: Sequence[str] = (),
    kept: str = "7 days",
) -> StreamingQuery:
    """Consume landed messages, then stop.

    Each batch owns one partition of both tables and overwrites it, so a repeated batch
    leaves no duplicates. The checkpoint marks messages as completed. With ``unique`` a message that is
    delivered again, in the same batch or a later one, is left out: its fields are kept in the
    state store for ``kept`` after it landed first. State is partitioned by message, never by company.
    """
    def consume(batch: DataFrame, batch_id: int) -> None:
        read = batch if unique else read_messages(batch, ddl)
        read = read.persist(StorageLevel.MEMORY_AND_DISK)  # parsed once
        try:
            good, bad = split_messages(read)
            good.write.mode("overwrite").parquet(f"{good_folder}/batch_id={batch_id}")
            bad.write.mode("overwrite").parquet(f"{bad_folder}/batch_id={batch_id}")
        finally:
            read.unpersist()

    landed = spark.readStream.text(landing, wholetext=one_per_file)
    messages = landed.select("value", F.col("_metadata.file_modification_time").alias("landed_at"))
    stream = _told_once(messages, ddl, unique, kept) if unique else messages.drop("landed_at")
    return (
        stream.writeStream.foreachBatch(consume)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
