"""Stuck-message monitor, to be run by schedule.

A message turns stuck by waiting, without a new event, and stops being stuck when it lands
again with another state. So landed messages are merged into a current table by message id,
and every run asks that table, whether anything landed or not.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerhub.plans.alerts import stuck_messages
from ledgerhub.streaming.upserts import upsert_stream


def watch(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    table: str,
    keys: list[str],
    checkpoint: str,
    alert_folder: str,
    base: str,
    now: datetime,
    arrival: Sequence[str] = (),
    rejects: str | None = None,
    **options,
) -> DataFrame:
    """Bring ``table`` up to date with what landed, then alert on its state at ``now``.

    The last arrival of a message wins. The alerts of a run are stored under its time, and
    overwritten when the run is repeated.
    """
    upsert_stream(
        spark, landing, schema, table, keys, checkpoint, arrival=arrival, rejects=rejects
    ).awaitTermination()
    at = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    alerts = stuck_messages(spark.table(table), base, at, **options)
    folder = f"{alert_folder}/checked_at={now:%Y%m%dT%H%M%S}"
    alerts.write.mode("overwrite").parquet(folder)
    return spark.read.schema(alerts.schema).parquet(folder)
