"""Incremental polling: landed files are merged into a table as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerhub.operators.latest import last_per_key
from ledgerhub.operators.load import upsert
from ledgerhub.operators.versions import latest_versions, merge_by_version
from ledgerhub.sinks import tables

#: Where a row came from: the later file wins, in a file the later row.
LANDED = {"_landed_at": "file_modification_time", "_landed_in": "file_path", "_landed_row": "row_index"}


def upsert_stream(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    table: str,
    keys: list[str],
    checkpoint: str,
    files_per_batch: int | None = None,
    arrival: Sequence[str] = (),
    rejects: str | None = None,
    version: str | None = None,
) -> StreamingQuery:
    """Merge every new landed file into ``table``, then stop.

    Polls by change date overlap and several may land before a run, so of a key that a batch
    has more than once the last arrival is taken: by the columns ``arrival``, then by file and
    place. Merging the same batch twice changes nothing, so a batch repeated after a failure is
    harmless. Only companies in which the batch changes stored rows are rewritten. Rows with a
    NULL in a key are refused, or set aside below ``rejects``, one folder per batch.

    With ``version`` that column decides instead of the arrival, also against stored rows: an older
    version that lands later changes nothing, in whatever order files come (``operators/versions.py``).
    """
    def change(target: DataFrame, rows: DataFrame) -> DataFrame:
        if version is not None:
            return merge_by_version(target, rows, keys, version, measured=True)
        return upsert(target, rows, keys, measured=True)

    def merge(batch: DataFrame, batch_id: int) -> None:
        if version is not None:
            latest = latest_versions(batch.drop(*LANDED), keys, version)
        else:
            latest = last_per_key(batch, keys, [*arrival, *LANDED]).drop(*LANDED)
        keyless = batch.where(" or ".join(f"`{k}` is null" for k in keys)).drop(*LANDED)
        kept = latest.where(" and ".join(f"`{k}` is not null" for k in keys)).unionByName(keyless)
        kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tables.change_companies(
                kept, table, keys, change, rejects=rejects and f"{rejects}/batch_id={batch_id}",
            )
        finally:
            kept.unpersist()

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(landing)
    return (
        rows.select("*", *[F.col(f"_metadata.{field}").alias(name) for name, field in LANDED.items()])
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
