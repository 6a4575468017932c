"""What to pull next: the time that no successful run of a job covers yet, per company.

"Changed since yesterday" loses the changes of every day on which a run failed or none was started. The run
log tells which windows were pulled with success; what they leave open up to now is pulled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerhub.functions.text import quoted
from ledgerhub.operators import intervals
from ledgerhub.sizing import broadcast_within

#: Times are compared as microseconds: rows in ranges of a day, windows in ranges of a year.
DAY = 86_400_000_000
YEAR = 366 * DAY
ALL = "All"


def _micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def covered_windows(log: DataFrame, job: str, names: DataFrame, days: int = 1) -> DataFrame:
    """Disjoint intervals (Entity, lo, hi) that successful runs of a job pulled.

    A run pulls changes from midnight ``days`` before its start day up to its start; what changes while it runs
    may be missed by it. ``log`` is the run log. A row for all companies counts for each of ``names``.
    """
    ok = log.where((F.col("Status") == "Success") & (F.col("Name") == job) & F.col("StartDateTime").isNotNull())
    start = F.col("StartDateTime")
    runs = ok.select(
        F.col("company_name").alias("Entity"), _micros(F.date_sub(start.cast("date"), days)).alias("lo"), _micros(start).alias("hi"))
    every = names.select(F.col("name").alias("_name")).distinct()
    counts_for = every.select("_name", F.explode(F.array("_name", F.lit(ALL))).alias("Entity"))
    told = intervals.united(runs, width=YEAR).join(broadcast_within(counts_for), "Entity")
    return intervals.united(told.select(F.col("_name").alias("Entity"), "lo", "hi"), width=YEAR)


def pull_windows(
    log: DataFrame, job: str, names: DataFrame, since: Column, now: Column, days: int = 1
) -> DataFrame:
    """(Entity, pull_from, pull_to) of the windows from ``since`` to ``now`` that no run covers, the end not included.

    A company without a successful run gets the whole time. Companies that are not in ``names`` get none.
    """
    every = names.select(F.col("name").alias("Entity")).distinct()
    whole = every.select("Entity", _micros(since).alias("lo"), _micros(now).alias("hi"))
    left = intervals.without(whole, covered_windows(log, job, names, days), width=YEAR)
    return left.select("Entity", F.timestamp_micros("lo").alias("pull_from"), F.timestamp_micros("hi").alias("pull_to"))


def changed_in(rows: DataFrame, changed: str, windows: DataFrame) -> DataFrame:
    """Rows whose change time lies in one of their company's windows."""
    cut = windows.select("Entity", _micros(F.col("pull_from")).alias("lo"), _micros(F.col("pull_to")).alias("hi"))
    timed = rows.withColumn("_micros", _micros(F.col(quoted([changed])[0])))
    return intervals.covered(timed, "_micros", cut, width=DAY).drop("_micros")
