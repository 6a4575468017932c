"""Alert tables. Events are job queue entries and messages, users are companies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerhub.plans import alerts
from ledgerhub.warehouse_queries.base import (
    companies, customer_companies, moment, query, read, registry,
)

BASE = "https://erp.example/?company="
NOW = "2024-01-15 12:00:00"


def _messages(spark, folder, *more):
    state = (
        F.when(F.col("event_type") == "error", "Failed")
        .when(F.col("event_type") == "signup", "New")
        .otherwise("Done")
    )
    kind = F.concat(F.lit("MSG"), F.regexp_extract("props", r"(\d+)", 1))
    return read(spark, folder, "events").select(
        state.alias("status"), kind.alias("messageType"), F.col("ts").alias("receivedAt"),
        F.col("user_id").cast("string").alias("Entity"), *more,
    )


_MESSAGES_SQL = r"""
WITH m AS (SELECT CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'New' ELSE 'Done' END AS status,
             'MSG' || regexp_extract(props, '(\d+)', 1) AS kind, ts,
             CAST(user_id AS VARCHAR) AS company_name FROM events)
"""


def _alert_sql(condition, wording, page, threshold=0):
    return _MESSAGES_SQL + f"""
SELECT company_name, count(*) AS row_count, count(*) || '{wording}' AS error_details,
       '{BASE}' || company_name || '{page}' AS link
FROM m WHERE {condition} GROUP BY company_name HAVING count(*) > {threshold}
"""


@query("failed_alerts", _alert_sql("status = 'Failed'", " error(s) found", "&page=672"))
def failed_alerts(spark, folder):
    jobs = _messages(spark, folder).withColumn(
        "Status", F.when(F.col("status") == "Failed", "Error").otherwise("Ready")
    )
    return alerts.failed_jobs(jobs, BASE)


@query("message_alerts", _alert_sql(
    "status = 'Failed' AND contains(kind, 'G7')", " errors found.", "&page=11242113"))
def message_alerts(spark, folder):
    return alerts.failed_messages(_messages(spark, folder), BASE, kind="G7")


@query("message_alerts_above_threshold", _alert_sql(
    "status = 'Failed' AND contains(kind, 'MSG')", " errors found.", "&page=11242113", 12))
def message_alerts_above_threshold(spark, folder):
    return alerts.failed_messages(_messages(spark, folder), BASE, kind="MSG", threshold=12)


@query("stale_alerts", _alert_sql(
    f"status = 'New' AND contains(kind, 'G1') AND ts < TIMESTAMP '{NOW}' - INTERVAL 5 MINUTE",
    " errors found.", "&page=11242113"))
def stale_alerts(spark, folder):
    return alerts.stuck_messages(_messages(spark, folder), BASE, moment(NOW), kind="G1")


@query("missing_master", """
SELECT n_name AS company_name, CAST(0 AS BIGINT) AS row_count,
       'Mismatch in row count for ' || n_name || ': API rows 0' AS error_details
FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('AFRICA', 'ASIA') AND n_name <> 'NATION_5'
""")
def missing_master(spark, folder):
    """Partner ids are NULL in AFRICA and empty in ASIA; one company is left out."""
    owner = customer_companies(spark, folder)
    partner = (
        F.when(F.col("region") == "AFRICA", F.lit(None).cast("string"))
        .when(F.col("region") == "ASIA", "")
        .otherwise(F.col("c_custkey").cast("string"))
    )
    partners = owner.select(partner.alias("Central_Layer_Partner_ID"), "Entity")
    return alerts.companies_without_partner(registry(spark, folder), partners, ["NATION_5"])
