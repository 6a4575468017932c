"""Sums of a stored table, kept up to date by its loads instead of read from all its rows.

Each load leaves what it changed: the sums of the rows it added less those of the rows it replaced, per
account and company. The batch's own rows, and of the table only rows with a key of the batch, are read
for that. Adding up all that the loads left gives the table's sums, whatever their order and number.

A run has a name. What it will change is stored before the table is written and counts from when the
table is; a run repeated under its name finds the first of these and changes nothing twice. If a run ended
in between, the sums are those of the table before it until it is repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerhub.functions.text import quoted
from ledgerhub.operators.alignment import EXACT
from ledgerhub.operators.binding import ENTITY
from ledgerhub.operators.presence import present
from ledgerhub.plans import extract
from ledgerhub.plans.catalog import Dataset
from ledgerhub.plans.effects import REFRESHES, held_before, replaced_and_added


@dataclass(frozen=True)
class Sums:
    """Where the sums of a table are kept, and of what: ``amount`` per ``account`` and company."""

    folder: str
    account: str
    amount: str
    entity: str = ENTITY

    def of(self, rows: DataFrame, sign: int = 1) -> DataFrame:
        """account, company, amount and number of rows, each row by itself."""
        return rows.select(
            F.col(quoted([self.account])[0]).cast("string").alias("account"), F.col(quoted([self.entity])[0]).alias(ENTITY),
            (F.coalesce(F.col(quoted([self.amount])[0]), F.lit(0)).cast(EXACT) * sign).cast(EXACT).alias("amount"),
            F.lit(sign).cast("long").alias("rows"),
        )

    def changed(self, added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
        """What a load changes: one aggregate over both sides, sums formed in the map tasks."""
        parts = self.of(added) if removed is None else self.of(added).unionByName(self.of(removed, -1))
        return _added_up(parts)

    def _run(self, kind: str, name: str) -> str:
        return f"{self.folder}/{kind}/run={name}"


def _added_up(parts: DataFrame) -> DataFrame:
    summed = parts.groupBy("account", ENTITY).agg(
        F.sum("amount").cast(EXACT).alias("amount"), F.sum("rows").alias("rows"))
    return summed.where((F.col("amount") != 0) | (F.col("rows") != 0))


def _written(spark: SparkSession, folder: str) -> bool:
    """Whether a folder was written to its end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


SCHEMA = f"account STRING, {ENTITY} STRING, amount {EXACT}, rows BIGINT"


def current(spark: SparkSession, sums: Sums) -> DataFrame:
    """(account, company, amount, rows) of the table, from what its loads left; empty if there were none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sums.folder}/done")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SCHEMA)
    return _added_up(spark.read.schema(f"{SCHEMA}, run STRING").parquet(f"{sums.folder}/done").drop("run"))


def compact(spark: SparkSession, sums: Sums, folder: str) -> Sums:
    """The sums as those of one load in a new folder, to be used from then on instead of the old one."""
    new = Sums(folder, sums.account, sums.amount, sums.entity)
    current(spark, sums).write.parquet(new._run("done", "compacted"))
    return new


def run(
    entry: Dataset, landed: DataFrame, table: str, run_date: str, sums: Sums, name: str,
    complete: DataFrame | None = None, registered: DataFrame | None = None,
) -> None:
    """:func:`extract.run` that keeps the sums up to date.

    A refresh takes off what the sums hold of the companies that it empties or replaces, so it doesn't
    read their old rows either. ``complete`` and ``registered`` as there.
    """
    spark = landed.sparkSession
    batch = extract.batch_of(entry, landed, table, run_date)
    planned = sums._run("planned", name)
    held = None
    if not _written(spark, planned):
        if entry.load in REFRESHES:
            change = _refreshed(spark, entry, batch, sums, complete, registered)
        else:
            held = held_before(entry, batch, table)
            removed, added = replaced_and_added(entry, batch, table, held)
            change = sums.changed(added, removed)
        change.write.mode("overwrite").parquet(planned)
    extract.apply(entry, batch, table, complete, registered, held)
    spark.read.schema(SCHEMA).parquet(planned).write.mode("overwrite").parquet(sums._run("done", name))


def _refreshed(
    spark: SparkSession, entry: Dataset, batch: DataFrame, sums: Sums, complete: DataFrame | None, registered: DataFrame | None,
) -> DataFrame:
    """Change of a refresh: companies that landed are new, those known to be empty or gone are taken off."""
    if ENTITY not in batch.columns:
        raise ValueError("sums are kept per company")
    held = current(spark, sums)
    company = F.col(sums.entity).alias(ENTITY)
    gone = batch.select(company)
    if complete is not None:
        gone = gone.unionByName(complete.select(company))
    if registered is not None:
        names = held.select(ENTITY).distinct()
        gone = gone.unionByName(names.join(registered.select(company).distinct(), ENTITY, "left_anti"))
    off = present(held, gone, [ENTITY]).select(
        "account", ENTITY, (-F.col("amount")).cast(EXACT).alias("amount"), (-F.col("rows")).alias("rows"))
    return _added_up(sums.of(batch).unionByName(off))


def staging_amounts(spark: SparkSession, sums: Sums) -> DataFrame:
    """The staging side of the balance check (``balance.staging_amounts``) from the sums."""
    return current(spark, sums).select("account", ENTITY, "amount")


def apart(table: DataFrame, sums: DataFrame, s: Sums) -> DataFrame:
    """Accounts for which the kept sums are not those of the table's rows; reads the whole table."""
    both = s.of(table).unionByName(sums.select(
        "account", ENTITY, (-F.col("amount")).cast(EXACT).alias("amount"), (-F.col("rows")).alias("rows")))
    return _added_up(both)
