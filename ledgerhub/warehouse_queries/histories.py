"""Snapshots, what failed runs left out, and XML files with many messages, on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ledgerhub.operators import binding, history
from ledgerhub.plans import pull_windows
from ledgerhub.scratch import run_folder
from ledgerhub.sinks import files
from ledgerhub.sources import messages
from ledgerhub.warehouse_queries.base import moment, plain, query, read, registry

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"]


def _snapshots(spark, folder):
    """Parts as five pulls of 25 companies show them: prices of some change and come back, some parts are missing
    for a pull, company 3 is pulled on three days only."""
    part, store = read(spark, folder, "part"), run_folder(spark, "snapshots")
    number = F.col("p_partkey")
    for i, day in enumerate(DAYS):
        rows = part.where(f"p_partkey % 10 <> {i} and (p_partkey % 25 <> 3 or {i} % 2 = 0)").select(
            F.concat(F.lit("C"), (number % 25).cast("string")).alias("Entity"), number.alias("no"),
            F.when((number % 7 == 2) & F.lit(i == 2), F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("price"),
            F.when((number % 11 != 5) | F.lit(i < 3), F.col("p_brand")).alias("brand"),
        )
        files.append_snapshot(binding.stamped(rows, moment(f"{day} 06:00:00")), store)
    return spark.read.parquet(store).drop("snapshot_day")


_SNAPSHOT_SQL = """
WITH d AS (SELECT i, TIMESTAMP '2024-01-01 06:00:00' + i * INTERVAL 1 DAY AS taken FROM range(5) t(i)),
s AS (SELECT 'C' || p_partkey % 25 AS "Entity", p_partkey AS no, p_partkey % 25 = 3 AS sparse, i, taken,
             CASE WHEN p_partkey % 7 = 2 AND i = 2 THEN p_retailprice + 1 ELSE p_retailprice END AS price,
             CASE WHEN p_partkey % 11 <> 5 OR i < 3 THEN p_brand END AS brand
      FROM part, d WHERE p_partkey % 10 <> i AND (p_partkey % 25 <> 3 OR i % 2 = 0)),
l AS (SELECT *, lag(i) OVER k AS li, lag(price) OVER k AS lp, lag(brand) OVER k AS lb FROM s
      WINDOW k AS (PARTITION BY "Entity", no ORDER BY i)),
m AS (SELECT *, CASE WHEN li IS NULL OR li < i - CASE WHEN sparse THEN 2 ELSE 1 END OR lp <> price
                       OR lb IS DISTINCT FROM brand THEN 1 ELSE 0 END AS fresh FROM l),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY "Entity", no ORDER BY i) AS version FROM m),
h AS (SELECT "Entity", no, min(price) AS price, min(brand) AS brand, min(taken) AS f,
             max(i) + CASE WHEN any_value(sparse) THEN 2 ELSE 1 END AS nxt FROM g GROUP BY "Entity", no, version)
"""


@query("snapshot_history", _SNAPSHOT_SQL + """
SELECT "Entity", no, price, brand, strftime(f, '%Y-%m-%d') AS valid_from,
       CASE WHEN nxt < 5 THEN strftime(DATE '2024-01-01' + CAST(nxt AS INTEGER), '%Y-%m-%d') END AS valid_to
FROM h
""")
def snapshot_history(spark, folder):
    """A row per version of a part instead of one per pull."""
    found = history.collapsed(_snapshots(spark, folder), ["Entity", "no"])
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return found.select("Entity", "no", "price", "brand", day("valid_from"), day("valid_to"))


@query("snapshot_extended", _SNAPSHOT_SQL + """
SELECT "Entity", no, price, brand, strftime(f, '%Y-%m-%d') AS valid_from,
       CASE WHEN nxt < 5 THEN strftime(DATE '2024-01-01' + CAST(nxt AS INTEGER), '%Y-%m-%d') END AS valid_to
FROM h
""")
def snapshot_extended(spark, folder):
    """The same history, of three pulls collapsed and two that extend it one after the other."""
    rows = _snapshots(spark, folder)
    found = history.collapsed(rows.where(F.col("snapshot_ts") < moment("2024-01-04")), ["Entity", "no"])
    for day in DAYS[3:]:
        at = moment(f"{day} 06:00:00")
        pull = rows.where(F.col("snapshot_ts") == at).drop("snapshot_ts")
        found = history.extended(found, pull, at, ["Entity", "no"])
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return found.select("Entity", "no", "price", "brand", day("valid_from"), day("valid_to"))


@query("snapshot_as_of", _SNAPSHOT_SQL + """,
o AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
             TIMESTAMP '2023-12-31 18:00:00' + CAST(l_orderkey % 7 AS INTEGER) * INTERVAL 1 DAY AS moment FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey AS no, l_quantity, 'C' || l_partkey % 25 AS "Entity", price, brand
FROM o LEFT JOIN h ON h.no = l_partkey AND f <= moment
  AND (nxt >= 5 OR moment < TIMESTAMP '2024-01-01 06:00:00' + CAST(nxt AS INTEGER) * INTERVAL 1 DAY)
""")
def snapshot_as_of(spark, folder):
    """Lines with the price and brand their part had at the line's time."""
    found = history.collapsed(_snapshots(spark, folder), ["Entity", "no"])
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("no"), "l_quantity",
        F.concat(F.lit("C"), (F.col("l_partkey") % 25).cast("string")).alias("Entity"),
        (moment("2023-12-31 18:00:00") + F.make_dt_interval(days=(F.col("l_orderkey") % 7).cast("int"))).alias("at"),
    )
    return history.joined_as_of(lines, found, ["Entity", "no"], "at").drop("at")


def _run_log(spark, folder):
    """Orders as runs of a job, a company's started at 06:00 on the order's day; those of urgent ones failed."""
    orders = read(spark, folder, "orders").where("o_orderdate < '1995-07-01'")
    start = F.col("o_orderdate").cast("date").cast("timestamp") + F.make_dt_interval(hours=F.lit(6))
    return orders.select(
        F.when(F.col("o_orderpriority") == "1-URGENT", "Error").otherwise("Success").alias("Status"),
        F.when(F.col("o_orderstatus") == "P", "other").otherwise("lines").alias("Name"), start.alias("StartDateTime"),
        F.when(F.col("o_custkey") % 400 == 0, "All").otherwise(
            F.concat(F.lit("NATION_"), (F.col("o_custkey") % 200).cast("string"))).alias("company_name"),
    )


_WINDOWS_SQL = """
WITH runs AS (
  SELECT CASE WHEN o_custkey % 400 = 0 THEN 'All' ELSE 'NATION_' || o_custkey % 200 END AS company, CAST(o_orderdate AS DATE) AS day
  FROM orders WHERE o_orderdate < '1995-07-01' AND o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'P'),
c AS (SELECT n_name AS "Entity", CAST(day - INTERVAL 1 DAY AS TIMESTAMP) AS f, day + INTERVAL 6 HOUR AS t
      FROM runs JOIN nation ON company IN ('All', n_name)),
p AS (SELECT "Entity", greatest(f, TIMESTAMP '1995-01-01') AS f, least(t, TIMESTAMP '1995-06-01') AS t FROM c
      WHERE t > TIMESTAMP '1995-01-01' AND f < TIMESTAMP '1995-06-01'
      UNION ALL SELECT n_name, TIMESTAMP '1995-01-01', TIMESTAMP '1995-01-01' FROM nation
      UNION ALL SELECT n_name, TIMESTAMP '1995-06-01', TIMESTAMP '1995-06-01' FROM nation),
m AS (SELECT "Entity", f, max(t) OVER (PARTITION BY "Entity" ORDER BY f, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS till FROM p),
w AS (SELECT "Entity", till AS a, f AS b FROM m WHERE till < f)
"""


@query("pull_windows", _WINDOWS_SQL + """
SELECT "Entity", strftime(a, '%Y-%m-%d %H:%M:%S') AS pull_from, strftime(b, '%Y-%m-%d %H:%M:%S') AS pull_to FROM w
""")
def open_windows(spark, folder):
    """What failed and skipped runs of the first half of 1995 left open, per company."""
    found = pull_windows.pull_windows(
        _run_log(spark, folder), "lines", registry(spark, folder), moment("1995-01-01"), moment("1995-06-01"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return found.select("Entity", text("pull_from"), text("pull_to"))


@query("pulled_changes", _WINDOWS_SQL + """
SELECT l_orderkey, l_linenumber, l_suppkey, "Entity" FROM (
  SELECT *, 'NATION_' || l_suppkey % 25 AS e, l_shipdate + CAST(l_orderkey % 24 AS INTEGER) * INTERVAL 1 HOUR AS changed FROM lineitem)
JOIN w ON w."Entity" = e AND changed >= a AND changed < b
""")
def pulled_changes(spark, folder):
    """Lines that changed in a window that is still to be pulled."""
    windows = pull_windows.pull_windows(
        _run_log(spark, folder), "lines", registry(spark, folder), moment("1995-01-01"), moment("1995-06-01"))
    changed = F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.concat(F.lit("NATION_"), (F.col("l_suppkey") % 25).cast("string")).alias("Entity"), changed.alias("changed"))
    return pull_windows.changed_in(lines, "changed", windows).drop("changed")


XML_MESSAGE = T.StructType().add("id", "long").add("kind", "string").add("amount", T.DecimalType(18, 2)).add(
    "lines", T.StructType().add("line", T.ArrayType(T.LongType())))


def _xml_files(spark, folder):
    """Events as XML files with many messages each; of type error some lack their end tag of an element, others
    have a text where the amount is."""
    e = read(spark, folder, "events")
    amount = F.when((F.col("event_type") == "error") & (F.col("event_id") % 2 == 0), F.lit("none")).otherwise(
        F.col("value").cast("decimal(18,2)").cast("string"))
    kind = F.when((F.col("event_type") == "error") & (F.col("event_id") % 2 == 1), F.lit("<kind>error")).otherwise(
        F.concat(F.lit("<kind>"), F.col("event_type"), F.lit(" &amp; more</kind>")))
    message = F.concat(
        F.lit("<invoice><id>"), F.col("event_id").cast("string"), F.lit("</id>"), kind, F.lit("<amount>"), amount,
        F.lit("</amount><lines><line>"), F.col("user_id").cast("string"), F.lit("</line><line>7</line></lines></invoice>"))
    store = run_folder(spark, "xml")
    e.select(message.alias("value")).repartition(3).write.text(store)
    return messages.read_xml(spark, store, "invoice", XML_MESSAGE)


@query("xml_batch", """
SELECT event_id AS id, event_type || ' & more' AS kind, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount,
       user_id || '+7' AS line FROM events WHERE event_type <> 'error'
""")
def xml_batch(spark, folder):
    """Messages of files that hold many, with a repeated element."""
    good, _ = messages.good_and_bad(_xml_files(spark, folder))
    return good.select("id", "kind", plain("amount").alias("amount"), F.concat_ws("+", F.expr("transform(lines.line, x -> cast(x as string))")).alias("line"))


@query("xml_batch_rejects", """
SELECT event_id AS id, CASE WHEN event_id % 2 = 0 THEN 'amount' ELSE 'not well-formed' END AS problem
FROM events WHERE event_type = 'error'
""")
def xml_batch_rejects(spark, folder):
    """The text of messages that could not be read, with what is wrong as far as these show it."""
    _, bad = messages.good_and_bad(_xml_files(spark, folder))
    problem = F.when(F.col("payload").contains("<amount>none"), "amount").otherwise("not well-formed")
    return bad.select(F.regexp_extract("payload", r"<id>(\d+)", 1).cast("long").alias("id"), problem.alias("problem"))
