"""Run log: typed rows, the read-back check of a load, and the run summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerhub.functions.times import whole_minutes

RUN_LOG_DDL = (
    "Status STRING, Categorie STRING, Name STRING, StartDateTime TIMESTAMP, "
    "EndDateTime TIMESTAMP, TimeRunInMinutes INT, RecordsInserted BIGINT, "
    "error_details STRING, company_name STRING, URi STRING"
)


def log_row(
    spark: SparkSession,
    status: str,
    category: str,
    name: str,
    start: datetime,
    end: datetime,
    records: int | None,
    details: str,
    company: str = "All",
    uri: str = "N/A",
) -> DataFrame:
    """One row for the run log; an unknown count is NULL."""
    minutes = int((end - start).total_seconds() / 60)
    row = (status, category, name, start, end, minutes, records, details, company, uri)
    return spark.createDataFrame([row], RUN_LOG_DDL)


def log_rows(runs: DataFrame, category: str, name: str) -> DataFrame:
    """Run log rows from one row per company run.

    ``runs`` has company, ok, started, ended, records, details and uri.
    """
    return runs.select(
        F.when(F.col("ok"), "Success").otherwise("Error").alias("Status"),
        F.lit(category).alias("Categorie"),
        F.lit(name).alias("Name"),
        F.col("started").alias("StartDateTime"),
        F.col("ended").alias("EndDateTime"),
        whole_minutes(F.col("started"), F.col("ended")).alias("TimeRunInMinutes"),
        F.col("records").cast("long").alias("RecordsInserted"),
        F.col("details").alias("error_details"),
        F.col("company").alias("company_name"),
        F.col("uri").alias("URi"),
    )


def load_check(batch: DataFrame, read_back: DataFrame, entity: str = "Entity") -> DataFrame:
    """Per company: rows pulled against rows found in the table after the load."""
    rows = batch.select(entity, F.lit(True).alias("is_pulled")).unionByName(
        read_back.select(entity, F.lit(False).alias("is_pulled"))
    )
    both = rows.groupBy(entity).agg(
        F.count_if("is_pulled").alias("pulled"), F.count_if(~F.col("is_pulled")).alias("inserted")
    )
    status = F.when(F.col("pulled") == F.col("inserted"), "Success").otherwise("Error")
    return both.select(entity, "pulled", "inserted", status.alias("status"))


def run_summary(log: DataFrame) -> DataFrame:
    """Per company: runs that succeeded, runs that failed, rows inserted, minutes run."""
    ok = F.col("Status") == "Success"
    return log.groupBy("company_name").agg(
        F.count_if(ok).alias("successes"),
        F.count_if(~ok).alias("failures"),
        F.coalesce(F.sum(F.when(ok, F.col("RecordsInserted"))), F.lit(0)).alias("rows_inserted"),
        F.coalesce(F.sum("TimeRunInMinutes"), F.lit(0)).alias("minutes"),
    )


def run_totals(summary: DataFrame) -> DataFrame:
    """Companies with a failure and rows moved, over all companies."""
    return summary.agg(
        F.count_if(F.col("failures") > 0).alias("companies_in_error"),
        F.sum("rows_inserted").alias("rows_inserted"),
    )
