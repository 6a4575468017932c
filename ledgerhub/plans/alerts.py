"""Alert tables: one row per company that needs attention. Delivery happens elsewhere."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerhub import fixed_values as fv
from ledgerhub.functions.text import deep_link
from ledgerhub.operators.changes import older_than
from ledgerhub.operators.counts import rows_per_company
from ledgerhub.sources.registry import company_names


def _alerts(
    rows: DataFrame, base: str, page: str, wording: str, threshold: int, entity: str
) -> DataFrame:
    counted = rows_per_company(rows, entity, name="row_count")
    return counted.where(F.col("row_count") > threshold).select(
        F.col(entity).alias("company_name"),
        "row_count",
        F.format_string(wording, "row_count").alias("error_details"),
        deep_link(base, F.col(entity).cast("string"), page).alias("link"),
    )


def failed_jobs(
    job_queue: DataFrame, base: str, threshold: int = fv.ALERT_THRESHOLD, entity: str = "Entity"
) -> DataFrame:
    """Companies with job queue entries in error."""
    failed = job_queue.where(F.col("Status") == "Error")
    return _alerts(failed, base, fv.JOB_QUEUE_PAGE, "%d error(s) found", threshold, entity)


def failed_messages(
    messages: DataFrame,
    base: str,
    kind: str = "CDM",
    threshold: int = fv.ALERT_THRESHOLD,
    entity: str = "Entity",
) -> DataFrame:
    """Companies with failed messages of a kind."""
    failed = messages.where(
        (F.col("status") == "Failed") & F.contains(F.col("messageType"), F.lit(kind))
    )
    return _alerts(failed, base, fv.MESSAGE_PAGE, "%d errors found.", threshold, entity)


def stuck_messages(
    messages: DataFrame,
    base: str,
    now: Column,
    kind: str = "CDM",
    minutes: int = fv.STUCK_MINUTES,
    threshold: int = fv.ALERT_THRESHOLD,
    entity: str = "Entity",
) -> DataFrame:
    """Companies with messages still new some minutes after they were received."""
    stuck = messages.where(
        (F.col("status") == "New")
        & F.contains(F.col("messageType"), F.lit(kind))
        & older_than(F.col("receivedAt"), now, minutes)
    )
    return _alerts(stuck, base, fv.MESSAGE_PAGE, "%d errors found.", threshold, entity)


def companies_without_partner(
    registry: DataFrame,
    partners: DataFrame,
    skip: Iterable[str] = (),
    entity: str = "Entity",
) -> DataFrame:
    """Registered companies with no partner id that is neither NULL nor empty."""
    filled = F.col("Central_Layer_Partner_ID") != ""
    counted = rows_per_company(partners.where(filled), entity, name="partners")
    names = company_names(registry, skip).select(F.col("name").alias(entity)).distinct()
    joined = names.join(counted, entity, "left")
    zero = joined.where(F.coalesce("partners", F.lit(0)) == 0)
    return zero.select(
        F.col(entity).alias("company_name"),
        F.lit(0).cast("long").alias("row_count"),
        F.format_string(
            "Mismatch in row count for %s: API rows 0", F.col(entity)
        ).alias("error_details"),
    )
