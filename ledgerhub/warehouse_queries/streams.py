"""Incremental jobs on landed copies of the given tables."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from ledgerhub.operators.versions import latest_versions, live, merge_by_version
from ledgerhub.scratch import run_folder
from ledgerhub.sinks import tables
from ledgerhub.streaming.inbox import inbox_stream
from ledgerhub.streaming.stuck import watch
from ledgerhub.streaming.upserts import upsert_stream
from ledgerhub.warehouse_queries.alerting import BASE, NOW, _messages
from ledgerhub.warehouse_queries.base import DOCUMENTS_SQL, documents, query, read


@query("stream_upsert", f"""
WITH {DOCUMENTS_SQL}
SELECT "entryNo", CASE WHEN priority = '1-URGENT' THEN 'Y' WHEN order_date >= '2000-01-01' THEN 'X' ELSE status END AS status,
       total, "Entity"
FROM o
""")
def stream_upsert(spark, folder):
    """Two runs with one checkpoint: first all older documents, then two polls that overlap."""
    landing, checkpoint = run_folder(spark, "landing"), run_folder(spark, "checkpoint")
    name = f"polled_{uuid.uuid4().hex}"
    rows = documents(spark, folder)
    shape = ["entryNo", "status", "total", "Entity"]
    schema = rows.select(*shape).schema
    tables.create(spark, name, schema, run_folder(spark, "table"))

    def poll():
        upsert_stream(
            spark, landing, schema, name, ["entryNo", "Entity"], checkpoint
        ).awaitTermination()

    rows.where("order_date < '2000-01-01'").select(*shape).write.mode("append").parquet(landing)
    poll()
    for condition, status in (("order_date >= '2000-01-01' or priority = '1-URGENT'", "X"), ("priority = '1-URGENT'", "Y")):
        rows.where(condition).withColumn("status", F.lit(status)).select(*shape).write.mode("append").parquet(landing)
    poll()
    return spark.table(name).select(*shape)


MESSAGE_DDL = "id STRING, kind STRING, amount STRING"


def _message_texts(spark, folder):
    """Events as XML messages; those of type error are cut off in the middle."""
    whole = F.concat(
        F.lit("<invoice><id>"), F.col("event_id").cast("string"), F.lit("</id><kind>"),
        F.col("event_type"), F.lit("</kind><amount>"),
        F.col("value").cast("decimal(18,2)").cast("string"), F.lit("</amount></invoice>"),
    )
    cut = F.concat(F.lit("<invoice><id>"), F.col("event_id").cast("string"), F.lit("</invoice>"))
    return read(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") == "error", cut).otherwise(whole).alias("value"))


def _landed_messages(spark, folder):
    """The messages one per line, and what became of them."""
    landing = run_folder(spark, "messages")
    _message_texts(spark, folder).select("value").write.text(landing)
    good, bad = run_folder(spark, "good"), run_folder(spark, "deadletter")
    inbox_stream(
        spark, landing, MESSAGE_DDL, good, bad, run_folder(spark, "checkpoint"), one_per_file=False
    ).awaitTermination()
    return good, bad


@query("stream_inbox", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind,
       CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount FROM events WHERE event_type <> 'error'
""")
def stream_inbox(spark, folder):
    good, _ = _landed_messages(spark, folder)
    return spark.read.parquet(good).drop("batch_id")


@query("stream_dead_letters", """
SELECT '<invoice><id>' || event_id || '</invoice>' AS payload FROM events WHERE event_type = 'error'
""")
def stream_dead_letters(spark, folder):
    _, bad = _landed_messages(spark, folder)
    return spark.read.parquet(bad).drop("batch_id")


@query("stream_stuck", f"""
SELECT company_name, count(*) AS row_count, count(*) || ' errors found.' AS error_details,
       '{BASE}' || company_name || '&page=11242113' AS link
FROM (SELECT 'U' || user_id % 20 AS company_name FROM events
      WHERE event_type = 'signup' AND user_id % 3 <> 0 AND ts < TIMESTAMP '{NOW}' - INTERVAL 5 MINUTE)
GROUP BY company_name
""")
def stream_stuck(spark, folder):
    """Messages land, some land again as done, others turn stuck while nothing lands."""
    landing, alerts, checkpoint = (run_folder(spark, p) for p in ("landing", "alerts", "checkpoint"))
    company = F.concat(F.lit("U"), (F.col("user_id") % 20).cast("string"))
    messages = _messages(spark, folder, "event_id", "user_id").withColumn("Entity", company)
    shape = ["event_id", "status", "messageType", "receivedAt", "Entity"]
    name, schema = f"messages_{uuid.uuid4().hex}", messages.select(*shape).schema
    tables.create(spark, name, schema, run_folder(spark, "table"))

    def check(now):
        return watch(
            spark, landing, schema, name, ["event_id", "Entity"], checkpoint, alerts, BASE,
            datetime.fromisoformat(now), kind="MSG",
        )

    messages.select(*shape).write.mode("append").parquet(landing)
    check("2000-01-01 00:00:00")  # all are new, none has waited
    done = messages.where("status = 'New' and user_id % 3 = 0").withColumn("status", F.lit("Done"))
    done.select(*shape).write.mode("append").parquet(landing)
    check("2000-01-01 00:01:00")
    return check(NOW)


@query("stream_redelivered", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind,
       CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount FROM events WHERE event_type <> 'error'
""")
def stream_redelivered(spark, folder):
    """Messages that land again, in the same run and after a restart, are stored once."""
    landing, good, bad, checkpoint = (run_folder(spark, p) for p in ("messages", "good", "deadletter", "checkpoint"))
    messages = _message_texts(spark, folder)
    for condition in ("event_id % 3 <> 0", "event_id % 3 <> 1"):  # a third lands in both runs, a fifth twice in one
        part = messages.where(condition)
        part.unionByName(part.where("event_id % 5 = 2")).select("value").write.mode("append").text(landing)
        inbox_stream(
            spark, landing, MESSAGE_DDL, good, bad, checkpoint, one_per_file=False, unique=["id"]
        ).awaitTermination()
    return spark.read.parquet(good).drop("batch_id")


_VERSIONS_SQL = f"""
WITH {DOCUMENTS_SQL},
v AS (SELECT "entryNo", "Entity", total + k AS total, k + CASE WHEN "entryNo" % 4 = 0 THEN 10 ELSE 0 END AS version,
             k = 2 AND "entryNo" % 5 = 1 AS deleted FROM o, range(4) t(k) WHERE "entryNo" % 6 >= k),
l AS (SELECT *, row_number() OVER (PARTITION BY "Entity", "entryNo" ORDER BY version DESC) AS place FROM v)
SELECT "entryNo", "Entity", total, CAST(version AS BIGINT) AS version FROM l WHERE place = 1 AND NOT deleted
"""


def _versions(spark, folder):
    """Up to four versions of each document; the third of some says that it is deleted."""
    number, k = F.col("entryNo"), F.col("k")
    rows = documents(spark, folder).withColumn("k", F.explode(F.sequence(F.lit(0), F.least(F.lit(3), (number % 6).cast("int")))))
    return rows.select(
        "entryNo", (F.col("total") + k).alias("total"),
        (k + F.when(number % 4 == 0, 10).otherwise(0)).cast("long").alias("version"),
        ((k == 2) & (number % 5 == 1)).alias("deleted"), "k", "Entity")


@query("merge_by_version", _VERSIONS_SQL)
def merge_versions(spark, folder):
    """The latest versions come first, then older ones and repeats: none of them changes anything."""
    rows, keys = _versions(spark, folder), ["entryNo", "Entity"]
    target = latest_versions(rows.where("k = 3 or entryNo % 6 < 2").drop("k"), keys, "version")
    for condition in ("k in (1, 2)", "k <> 2"):
        target = merge_by_version(target, rows.where(condition).drop("k"), keys, "version", measured=True)
    return live(target, "deleted").select("entryNo", "Entity", "total", "version")


@query("stream_out_of_order", _VERSIONS_SQL)
def stream_out_of_order(spark, folder):
    """Files land in an order that is not that of their versions, and some land twice."""
    landing, checkpoint, name = run_folder(spark, "landing"), run_folder(spark, "checkpoint"), f"versions_{uuid.uuid4().hex}"
    rows = _versions(spark, folder)
    schema = rows.drop("k").schema
    tables.create(spark, name, schema, run_folder(spark, "table"))
    for condition in ("k in (0, 3)", "k = 2", "k in (0, 1)"):
        rows.where(condition).drop("k").write.mode("append").parquet(landing)
        upsert_stream(
            spark, landing, schema, name, ["entryNo", "Entity"], checkpoint, version="version"
        ).awaitTermination()
    return live(spark.table(name), "deleted").select("entryNo", "Entity", "total", "version")
