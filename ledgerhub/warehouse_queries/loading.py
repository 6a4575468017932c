"""Load and merge patterns."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F, types as T

from ledgerhub.functions.text import no_trailing_blanks
from ledgerhub.operators import binding, changes, load
from ledgerhub.operators.counts import rows_per_company
from ledgerhub.operators.presence import absent, flagged
from ledgerhub.operators.watermark import high_watermarks
from ledgerhub.plans import catalog, count_check, effects, extract, run_log
from ledgerhub.scratch import run_folder, written_once
from ledgerhub.sinks import files, tables
from ledgerhub.sizing import company_side
from ledgerhub.sources import pages
from ledgerhub.sources.registry import company_names, for_companies
from ledgerhub.warehouse_queries.base import (
    DOCUMENTS_SQL, ENTRIES_SQL, LINES_SQL, companies, customer_companies, documents, entries,
    lines, moment, query, read, registry, supplier_companies,
)

HEADER = ["entryNo", "Entity", "status", "total", "order_date"]


def _ordered(spark, folder, condition):
    return documents(spark, folder, read(spark, folder, "orders").where(condition))


@query("watermark_max", f"""
WITH {DOCUMENTS_SQL}
SELECT "Entity", max("entryNo") AS max_entry_no FROM o GROUP BY "Entity"
""")
def watermark_max(spark, folder):
    return high_watermarks(documents(spark, folder), "entryNo")


@query("datamart_watermark", f"""
WITH {ENTRIES_SQL}
SELECT s_nationkey AS "DK_DimCompany", max(l_orderkey) AS "MaxEntryNo" FROM e GROUP BY s_nationkey
""")
def datamart_watermark(spark, folder):
    fact = entries(spark, folder).select(
        F.col("s_nationkey").alias("DK_DimCompany"), F.col("l_orderkey").alias("Boekstuknr")
    )
    return high_watermarks(fact, "Boekstuknr", "DK_DimCompany", "MaxEntryNo")


@query("append_above_watermark", f"""
WITH {DOCUMENTS_SQL},
t AS (SELECT * FROM o WHERE order_date < '1999-01-01' AND region <> 'EUROPE'),
w AS (SELECT "Entity", max("entryNo") AS top FROM t GROUP BY "Entity")
SELECT "entryNo", "Entity", status, total, order_date FROM t
UNION ALL
SELECT o."entryNo", o."Entity", status, total, order_date
FROM o LEFT JOIN w ON o."Entity" = w."Entity" WHERE o."entryNo" > coalesce(top, 0)
""")
def append_above_watermark(spark, folder):
    """Companies in EUROPE have never been loaded and start at 0."""
    target = _ordered(spark, folder, F.col("o_orderdate") < moment("1999-01-01"))
    target = target.where("region <> 'EUROPE'").select(*HEADER)
    return load.append_above(target, documents(spark, folder).select(*HEADER), "entryNo")


@query("upsert_merge", f"""
WITH {DOCUMENTS_SQL},
t AS (SELECT * FROM o WHERE order_date < '2000-01-01'),
b AS (SELECT "entryNo", "Entity", 'X' AS status, total + 1 AS total, order_date
      FROM o WHERE order_date >= '1999-07-01')
SELECT t."entryNo", t."Entity", t.status, t.total, t.order_date, t.priority
FROM t WHERE NOT EXISTS
  (SELECT 1 FROM b WHERE b."entryNo" = t."entryNo" AND b."Entity" = t."Entity")
UNION ALL
SELECT b."entryNo", b."Entity", b.status, b.total, b.order_date, t.priority
FROM b LEFT JOIN t ON b."entryNo" = t."entryNo" AND b."Entity" = t."Entity"
""")
def upsert_merge(spark, folder):
    """The batch lacks ``priority``: matched rows keep theirs, inserted rows have none."""
    target = _ordered(spark, folder, F.col("o_orderdate") < moment("2000-01-01"))
    batch = _ordered(spark, folder, F.col("o_orderdate") >= moment("1999-07-01"))
    changed = batch.select(*HEADER).withColumns(
        {"status": F.lit("X"), "total": F.col("total") + 1}
    )
    return load.upsert(target.select(*HEADER, "priority"), changed, ["entryNo", "Entity"])


@query("replace_keep_dups", f"""
WITH {LINES_SQL},
t AS (SELECT * FROM d WHERE ship_date < '2000-01-01'),
b AS (SELECT * FROM d WHERE ship_date >= '1999-06-01')
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.no = t.no AND b.line = t.line)
UNION ALL SELECT * FROM b
""")
def replace_keep_dups(spark, folder):
    frame = read(spark, folder, "lineitem")
    target = lines(frame.where(F.col("l_shipdate") < moment("2000-01-01")))
    batch = lines(frame.where(F.col("l_shipdate") >= moment("1999-06-01")))
    return load.replace_all(target, batch, ["no", "line"])


@query("replace_last_wins", f"""
WITH {LINES_SQL},
t AS (SELECT * FROM d WHERE ship_date < '2000-01-01'),
b AS (SELECT * FROM d WHERE ship_date >= '1999-06-01'),
r AS (SELECT b.*, row_number() OVER (PARTITION BY no, line ORDER BY ship_date DESC, part DESC,
        price DESC, quantity DESC, returnflag DESC, supplier DESC) AS place FROM b)
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.no = t.no AND b.line = t.line)
UNION ALL SELECT * EXCLUDE (place) FROM r WHERE place = 1
""")
def replace_last_wins(spark, folder):
    frame = read(spark, folder, "lineitem")
    target = lines(frame.where(F.col("l_shipdate") < moment("2000-01-01")))
    batch = lines(frame.where(F.col("l_shipdate") >= moment("1999-06-01")))
    return load.replace_last(target, batch, ["no", "line"], ["ship_date"])


@query("insert_absent", """
WITH t AS (
  SELECT c_custkey AS id, n_name AS "Entity", CAST(NULL AS VARCHAR) AS first_order, c_acctbal AS total
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
b AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS id, n_name AS "Entity",
         'S' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS first_order, o_totalprice AS total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
f AS (SELECT b.*, row_number() OVER (PARTITION BY id, "Entity" ORDER BY first_order, total) AS place
      FROM b WHERE id IS NOT NULL)
SELECT * FROM t UNION ALL
SELECT f.* EXCLUDE (place) FROM f WHERE place = 1 AND NOT EXISTS
  (SELECT 1 FROM t WHERE t.id = f.id AND t."Entity" = f."Entity")
""")
def insert_absent(spark, folder):
    owner = customer_companies(spark, folder).select("c_custkey", "Entity")
    known = read(spark, folder, "customer").where(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    )
    target = known.join(owner, "c_custkey").select(
        F.col("c_custkey").alias("id"), "Entity",
        F.lit(None).cast("string").alias("first_order"), F.col("c_acctbal").alias("total"),
    )
    orders = read(spark, folder, "orders")
    batch = orders.join(owner, orders.o_custkey == owner.c_custkey).select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("id"), "Entity",
        F.concat(F.lit("S"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("first_order"),
        F.col("o_totalprice").alias("total"),
    )
    return load.insert_absent(target, batch, ["id", "Entity"], ["first_order"], required="id")


@query("repair_by_count", f"""
WITH {DOCUMENTS_SQL},
t AS (SELECT * FROM o WHERE region IN ('ASIA', 'AMERICA') OR order_date < '2001-01-01'),
c AS (SELECT n_name AS "Entity",
        (SELECT count(*) FROM o WHERE o."Entity" = n_name) AS source_rows,
        (SELECT count(*) FROM t WHERE t."Entity" = n_name) AS table_rows,
        (SELECT max("entryNo") FROM t WHERE t."Entity" = n_name) AS top FROM nation)
SELECT o."entryNo", o."Entity", o.order_date
FROM o JOIN c ON o."Entity" = c."Entity"
WHERE source_rows <> table_rows AND "entryNo" > coalesce(top, 0)
UNION ALL SELECT "entryNo", "Entity", order_date FROM t
""")
def repair_by_count(spark, folder):
    source = documents(spark, folder)
    complete = F.col("region").isin("ASIA", "AMERICA") | (F.col("order_date") < "2001-01-01")
    table = source.where(complete).select("entryNo", "Entity", "order_date")
    source = source.select("entryNo", "Entity", "order_date")
    counts = source.groupBy("Entity").agg(F.count(F.lit(1)).alias("source_rows"))
    rows = count_check.repair_rows(registry(spark, folder), counts, source, table, "entryNo")
    return table.unionByName(rows)


@query("full_refresh_fanout", """
SELECT 'customer' AS kind, c_custkey AS no, c_name AS name, c_mktsegment AS segment, n_name AS "Entity"
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name <> 'AFRICA'
UNION ALL
SELECT 'vendor', s_suppkey, s_name, NULL, n_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name <> 'AFRICA'
""")
def full_refresh_fanout(spark, folder):
    """Customers and vendors of all registered companies in one scan each."""
    named = companies(spark, folder)
    names = named.where("region <> 'AFRICA'").select(F.col("Entity").alias("name"))
    customers = read(spark, folder, "customer").join(
        named, F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("no"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), "Entity",
    )
    vendors = read(spark, folder, "supplier").join(
        named, F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.lit("vendor").alias("kind"), F.col("s_suppkey").alias("no"),
        F.col("s_name").alias("name"), "Entity",
    )
    return for_companies(load.fan_out([customers, vendors]), names).select(
        "kind", "no", "name", "segment", "Entity"
    )


@query("staged_refresh", """
SELECT c_custkey AS no, c_name AS name, c_acctbal AS balance, n_name AS "Entity"
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def staged_refresh(spark, folder):
    """The record tag is staged but not stored."""
    owner = customer_companies(spark, folder).select("c_custkey", "Entity")
    landed = read(spark, folder, "customer").join(owner, "c_custkey").select(
        F.md5("c_name").alias("[@odata.etag]"), F.col("c_custkey").alias("no"),
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "Entity",
    )
    entry = catalog.dataset("BC_Customers_wide")
    return extract.loaded(entry, None, landed, "2001-01-01")


@query("extract_changed_lines", f"""
WITH {ENTRIES_SQL},
d AS (SELECT concat(l_orderkey, '-', l_linenumber) AS id, "Entity",
        CASE l_returnflag WHEN 'A' THEN 'Cost' WHEN 'R' THEN 'Service' ELSE 'Item' END AS type,
        l_extendedprice AS amount, l_quantity AS quantity, l_shipdate, l_partkey AS page_no,
        l_suppkey AS pos, strftime(l_shipdate, '%Y-%m-%d') AS modified FROM e),
t AS (SELECT * FROM d WHERE l_shipdate < '1999-06-01'),
b AS (SELECT * FROM d WHERE type IN ('Cost', 'Service') AND l_shipdate > '1999-05-01'),
r AS (SELECT b.*, row_number() OVER (PARTITION BY id, "Entity" ORDER BY page_no DESC, pos DESC,
        amount DESC, modified DESC, quantity DESC, l_shipdate DESC, type DESC) AS place FROM b)
SELECT id, "Entity", type, amount, quantity, modified FROM t
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.id = t.id AND b."Entity" = t."Entity")
UNION ALL
SELECT id, "Entity", type, amount, quantity, modified FROM r WHERE place = 1
""")
def extract_changed_lines(spark, folder):
    """Document lines: cost and service lines changed since the day before, last one wins."""
    kind = (
        F.when(F.col("l_returnflag") == "A", "Cost")
        .when(F.col("l_returnflag") == "R", "Service")
        .otherwise("Item")
    )
    landed = entries(spark, folder).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), "Entity",
        kind.alias("type"), F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("quantity"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("modified"),
        F.col("l_shipdate").alias("systemModifiedAt"),
        F.col("l_partkey").alias("page_no"), F.col("l_suppkey").alias("pos"),
    )
    target = landed.where(F.col("systemModifiedAt") < moment("1999-06-01"))
    entry = catalog.dataset("BC_wmsDL")
    after = extract.loaded(entry, target.drop("page_no", "pos"), landed, "1999-05-02")
    return after.select("id", "Entity", "type", "amount", "quantity", "modified")


@query("extract_invoice_headers", f"""
WITH {ENTRIES_SQL},
d AS (SELECT l_orderkey AS no, "Entity", l_extendedprice AS amount, l_returnflag AS "userID",
        strftime(l_shipdate, '%Y-%m-%d') AS day FROM e),
t AS (SELECT * REPLACE ('old' AS "userID") FROM d WHERE day < '2000-06-01'),
b AS (SELECT * FROM d WHERE day > '2000-05-01')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.no = t.no AND b."Entity" = t."Entity")
UNION ALL SELECT * FROM b
""")
def extract_invoice_headers(spark, folder):
    """Headers changed since the day before replace stored ones; repeats are all kept."""
    landed = entries(spark, folder).select(
        F.col("l_orderkey").alias("no"), "Entity", F.col("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("userID"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        F.col("l_shipdate").alias("systemModifiedAt"),
    )
    target = landed.where(F.col("systemModifiedAt") < moment("2000-06-01")).withColumn(
        "userID", F.lit("old")
    )
    entry = catalog.dataset("BC_PurchaseInvoiceHeader")
    return extract.loaded(entry, target, landed, "2000-05-02").drop("systemModifiedAt")


@query("extract_attachments", f"""
WITH {DOCUMENTS_SQL}
SELECT "entryNo", "Entity", 122 AS "Table_ID" FROM o WHERE priority = '1-URGENT'
""")
def extract_attachments(spark, folder):
    """Full refresh of the attachments of one table."""
    landed = documents(spark, folder).select(
        "entryNo", "Entity", F.when(F.col("priority") == "1-URGENT", 122).otherwise(36).alias("Table_ID")
    )
    return extract.loaded(catalog.dataset("BC_wmsRecordLink2"), None, landed, "2001-01-01")


@query("extract_budget", r"""
SELECT event_id AS "Entry_No",
  strftime(TRY_CAST('2024-02-' || lpad(regexp_extract(props, '(\d+)', 1), 2, '0') AS DATE), '%Y-%m-%d') AS "Date",
  CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS "Amount", CAST(NULL AS VARCHAR) AS "Description",
  CAST(user_id AS VARCHAR) AS "Entity"
FROM events
""")
def extract_budget(spark, folder):
    """Staged refresh bound by name: a date that does not parse is NULL, so is a missing field."""
    landed = read(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("Entry_No"),
        F.concat(F.lit("2024-02-"), F.regexp_extract("props", r"(\d+)", 1)).alias("[Date]"),
        F.col("value").cast("string").alias("Amount"), F.col("user_id").alias("Entity"),
    )
    schema = (
        T.StructType().add("Entry_No", "long").add("Date", "date").add("Amount", T.DecimalType(18, 2))
        .add("Description", "string").add("Entity", "string")
    )
    stored = extract.loaded(
        catalog.dataset("BC_GLbudget"), None, binding.bind(landed, schema), "2024-01-01"
    )
    return stored.withColumns(
        {"Date": F.date_format("Date", "yyyy-MM-dd"), "Amount": F.col("Amount").cast("double")}
    )


@query("changed_documents", f"""
WITH {DOCUMENTS_SQL}
SELECT 'since the day before' AS rule, "entryNo", order_date FROM o WHERE order_date > '2001-05-01'
UNION ALL
SELECT 'after a fixed day', "entryNo", order_date FROM o WHERE order_date > '2000-12-31' AND "Entity" = 'NATION_4'
UNION ALL
SELECT 'created on the day', "entryNo", order_date FROM o WHERE order_date = '2001-05-02'
""")
def changed_documents(spark, folder):
    """Row filters of the incremental loads and of the one-company snapshots."""
    rows = documents(spark, folder).withColumn("at", F.col("order_date").cast("date"))
    since = changes.modified_since(rows, "at", "2001-05-02")
    after = changes.modified_after(rows.where("Entity = 'NATION_4'"), "at", "2000-12-31")
    on_day = rows.where(changes.created_on(F.col("at"), "2001-05-02"))
    parts = [("since the day before", since), ("after a fixed day", after), ("created on the day", on_day)]
    return load.fan_out(
        [part.select(F.lit(rule).alias("rule"), "entryNo", "order_date") for rule, part in parts]
    )


@query("existing_keys", """
SELECT o_orderkey AS no, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS stored
FROM orders
""")
def existing_keys(spark, folder):
    """Every document is probed once: stored already, or not."""
    orders = read(spark, folder, "orders").select(F.col("o_orderkey").alias("no"))
    stored = read(spark, folder, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("no")
    )
    return flagged(orders, stored, ["no"], "stored")


@query("company_counts", f"""
WITH {DOCUMENTS_SQL}
SELECT a."Entity", a.rows, b.urgent FROM
  (SELECT "Entity", count(*) AS rows FROM o GROUP BY "Entity") a
  JOIN (SELECT "Entity", count(*) FILTER (WHERE priority = '1-URGENT') AS urgent FROM o GROUP BY "Entity") b
  ON a."Entity" = b."Entity"
""")
def company_counts(spark, folder):
    urgent = F.col("priority") == "1-URGENT"
    return rows_per_company(documents(spark, folder), conditions={"urgent": urgent})


@query("extract_record_links", f"""
WITH {DOCUMENTS_SQL},
d AS (SELECT "entryNo" AS id, "Entity", CASE priority WHEN '1-URGENT' THEN 122 WHEN '2-HIGH' THEN 0
        WHEN '3-MEDIUM' THEN 112 ELSE 18 END AS "tableNo", order_date AS created, status FROM o),
t AS (SELECT * REPLACE ('old' AS status) FROM d WHERE created < '2000-01-01'),
b AS (SELECT * FROM d WHERE "tableNo" IN (122, 0, 112) AND created > '1999-01-01')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.id = t.id AND b."Entity" = t."Entity")
UNION ALL SELECT * FROM b
""")
def extract_record_links(spark, folder):
    """Record links of three tables created since the day before, merged."""
    number = (
        F.when(F.col("priority") == "1-URGENT", 122)
        .when(F.col("priority") == "2-HIGH", 0)
        .when(F.col("priority") == "3-MEDIUM", 112)
        .otherwise(18)
    )
    landed = documents(spark, folder).select(
        F.col("entryNo").alias("id"), "Entity", number.alias("tableNo"),
        F.col("order_date").cast("date").alias("created"), "status",
    )
    target = landed.where(F.col("created") < F.lit("2000-01-01").cast("date")).withColumn(
        "status", F.lit("old")
    )
    entry = catalog.dataset("BC_wmsRecordLink")
    after = extract.loaded(entry, target, landed, "1999-01-02")
    return after.withColumn("created", F.date_format("created", "yyyy-MM-dd"))


@query("extract_ledger_merge", f"""
WITH {DOCUMENTS_SQL},
t AS (SELECT * FROM o WHERE order_date < '1998-01-01'),
w AS (SELECT "Entity", max("entryNo") AS top FROM t GROUP BY "Entity")
SELECT "entryNo" AS id, "entryNo", "Entity", total FROM t
UNION ALL
SELECT o."entryNo", o."entryNo", o."Entity", total
FROM o LEFT JOIN w ON o."Entity" = w."Entity" WHERE o."entryNo" > coalesce(top, 0)
""")
def extract_ledger_merge(spark, folder):
    """Ledger entries above the watermark, merged by id."""
    landed = documents(spark, folder).select(
        F.col("entryNo").alias("id"), "entryNo", "Entity", "total", "order_date"
    )
    target = landed.where("order_date < '1998-01-01'").drop("order_date")
    entry = catalog.dataset("BC_GLentries")
    return extract.loaded(entry, target, landed.drop("order_date"), "1998-01-01")


@query("stored_company_table", f"""
WITH {DOCUMENTS_SQL},
t AS (SELECT * FROM o WHERE order_date < '2000-01-01' AND region <> 'ASIA'),
b AS (SELECT * FROM o WHERE order_date >= '1999-07-01' AND region = 'EUROPE'),
u AS (SELECT "entryNo", "Entity", status, total FROM t
      WHERE NOT EXISTS (SELECT 1 FROM b WHERE b."entryNo" = t."entryNo" AND b."Entity" = t."Entity")
      UNION ALL SELECT "entryNo", "Entity", 'X', total FROM b),
w AS (SELECT "Entity", max("entryNo") AS top FROM u GROUP BY "Entity")
SELECT * FROM u
UNION ALL
SELECT o."entryNo", o."Entity", status, total FROM o LEFT JOIN w ON o."Entity" = w."Entity"
WHERE region = 'ASIA' AND o."entryNo" > coalesce(top, 0)
""")
def stored_company_table(spark, folder):
    """Refresh, company-wise upsert and append on a stored table, then read back."""
    name = f"documents_{uuid.uuid4().hex}"
    rows = documents(spark, folder).select("entryNo", "Entity", "status", "total", "order_date", "region")
    shape = ["entryNo", "status", "total", "Entity"]
    tables.create(
        spark, name, rows.select(*shape).schema, run_folder(spark, "table"), keys=["entryNo"], buckets=4
    )
    tables.refresh(rows.where("order_date < '2000-01-01' and region <> 'ASIA'").select(*shape), name)
    batch = rows.where("order_date >= '1999-07-01' and region = 'EUROPE'").select(*shape)
    tables.change_companies(
        batch.withColumn("status", F.lit("X")), name, ["entryNo", "Entity"],
        lambda target, new: load.upsert(target, new, ["entryNo", "Entity"], measured=True),
    )
    entry = catalog.Dataset("documents", "orders", catalog.APPEND, entry_no="entryNo")
    extract.run(entry, rows.where("region = 'ASIA'").select(*shape), name, "2001-01-01")
    return spark.table(name).select("entryNo", "Entity", "status", "total")


@query("stored_insert_absent", f"""
WITH {DOCUMENTS_SQL}
SELECT "entryNo", "Entity", CASE WHEN order_date < '1999-01-01' THEN status ELSE 'first' END AS status, total FROM o
""")
def stored_insert_absent(spark, folder):
    """Stored documents stay as they are; of new ones, landed twice, the first arrival is added."""
    name = f"absent_{uuid.uuid4().hex}"
    rows = documents(spark, folder).select("entryNo", "status", "total", "order_date", "Entity")
    shape = ["entryNo", "status", "total", "Entity"]
    tables.create(spark, name, rows.select(*shape).schema, run_folder(spark, "table"))
    tables.refresh(rows.where("order_date < '1999-01-01'").select(*shape), name)
    landed = [
        rows.select(*shape).withColumns({"status": F.lit(s), "page_no": F.lit(i), "pos": F.col("entryNo")})
        for i, s in ((1, "first"), (2, "second"))
    ]
    entry = catalog.Dataset("documents", "orders", catalog.INSERT_ABSENT, keys=("entryNo", "Entity"))
    for _ in range(2):  # a repeated run adds nothing
        extract.run(entry, landed[0].unionByName(landed[1]), name, "2001-01-01")
    return spark.table(name).select(*shape)


RECORD = T.StructType([
    T.StructField("entryNo", T.LongType()), T.StructField("status", T.StringType()), T.StructField("total", T.DoubleType()),
])
PAGES, PAGE_ROWS = 4, 1000


def _land(rows, versions):
    """Pages of the rows below a new folder: each row once per version, the last page without next link.

    A company has PAGES pages or more, of PAGE_ROWS rows on average, so their number grows with the table.
    """
    every = load.fan_out([rows.withColumn("status", F.coalesce(F.lit(v), F.col("status"))) for v in versions])
    asked = F.greatest(F.lit(PAGES), F.ceil(F.count(F.lit(1)) * len(versions) / PAGE_ROWS)).cast("long").alias("needed")
    needed = company_side(rows.where("Entity is not null").groupBy("Entity").agg(asked))
    page = (F.pmod(F.xxhash64("entryNo"), "needed") + 1).alias("page_no")
    # pages are numbered and linked on their own, so no company's records go through one task
    found = rows.join(needed, "Entity").select("Entity", page).distinct()  # companies with few rows may lack a page
    company = Window.partitionBy("Entity")
    numbers = written_once(found.select(
        "Entity", "page_no", F.row_number().over(company.orderBy("page_no")).alias("place"),
        F.count(F.lit(1)).over(company).alias("pages")), "numbers")
    numbered = every.join(needed, "Entity").groupBy("Entity", page).agg(
        F.sort_array(F.collect_list(F.struct("entryNo", "status", "total"))).alias("value"))
    linked = numbered.join(numbers, ["Entity", "page_no"])
    store = run_folder(rows.sparkSession, "landed")
    linked.select(
        "Entity", F.col("place").alias("page_no"), "value",
        F.when(F.col("place") < F.col("pages"), "next").alias(pages.NEXT_LINK),
    ).write.json(store)
    return store


def _landed_load(spark, folder, kind, versions):
    """Old documents land and are loaded, then later ones that overlap them; the table read back."""
    name, log = f"landed_{uuid.uuid4().hex}", run_folder(spark, "log")
    rows = written_once(documents(spark, folder).select("entryNo", "Entity", "status", "total", "order_date"), "documents")
    entry = catalog.Dataset("documents", "orders", kind, keys=("entryNo", "Entity"), entry_no="entryNo")
    stored = T.StructType([*RECORD.fields, T.StructField("Entity", T.StringType())])
    tables.create(spark, name, stored, run_folder(spark, "table"), keys=["entryNo"], buckets=4)
    for condition, named in (("order_date < '1999-01-01'", [None]), ("order_date >= '1998-01-01'", versions)):
        store = _land(rows.where(condition), named)
        rejects, drift = extract.run_landed(spark, entry, store, name, "2001-01-01", log, schema=RECORD)
        assert rejects.isEmpty() and drift.isEmpty()
    failed = spark.read.parquet(log).where("Status <> 'Success'")
    return spark.table(name).select("entryNo", "status", "total", "Entity").join(
        failed.select(F.col("company_name").alias("Entity")), "Entity", "left_anti"
    ).select("entryNo", "status", "total", "Entity")


_LANDED_SQL = f"""
WITH {DOCUMENTS_SQL},
t AS (SELECT "entryNo", status, total, "Entity", order_date FROM o WHERE order_date < '1999-01-01'),
n AS (SELECT "entryNo", total, "Entity", order_date FROM o WHERE order_date >= '1998-01-01'),
w AS (SELECT "Entity", max("entryNo") AS top FROM t WHERE "entryNo" > 0 GROUP BY "Entity"),
a AS (SELECT n.* FROM n LEFT JOIN w ON w."Entity" = n."Entity" WHERE n."entryNo" > coalesce(top, 0))
"""


@query("landed_refresh", _LANDED_SQL + """SELECT "entryNo", 'x' AS status, total, "Entity" FROM n
UNION ALL SELECT "entryNo", status, total, "Entity" FROM t WHERE "Entity" NOT IN (SELECT "Entity" FROM n)""")
def landed_refresh(spark, folder):
    return _landed_load(spark, folder, catalog.REFRESH, ["x"])


@query("landed_append", _LANDED_SQL + """SELECT "entryNo", status, total, "Entity" FROM t WHERE "entryNo" > 0
UNION ALL SELECT "entryNo", unnest(['x', 'y']), total, "Entity" FROM a""")
def landed_append(spark, folder):
    return _landed_load(spark, folder, catalog.APPEND, ["x", "y"])


@query("landed_append_merge", _LANDED_SQL + """SELECT "entryNo", status, total, "Entity" FROM t
WHERE "entryNo" > 0 UNION ALL SELECT "entryNo", 'x', total, "Entity" FROM a""")
def landed_append_merge(spark, folder):
    return _landed_load(spark, folder, catalog.APPEND_MERGE, ["x"])


@query("landed_merge", _LANDED_SQL + """SELECT "entryNo", status, total, "Entity" FROM t WHERE order_date < '1998-01-01'
UNION ALL SELECT "entryNo", 'x', total, "Entity" FROM n""")
def landed_merge(spark, folder):
    return _landed_load(spark, folder, catalog.MERGE, ["x"])


@query("landed_replace_all", _LANDED_SQL + """SELECT "entryNo", status, total, "Entity" FROM t
WHERE order_date < '1998-01-01' UNION ALL SELECT "entryNo", unnest(['x', 'y']), total, "Entity" FROM n""")
def landed_replace_all(spark, folder):
    return _landed_load(spark, folder, catalog.REPLACE_ALL, ["x", "y"])


@query("landed_replace_last", _LANDED_SQL + """SELECT "entryNo", status, total, "Entity" FROM t
WHERE order_date < '1998-01-01' UNION ALL SELECT "entryNo", 'y', total, "Entity" FROM n""")
def landed_replace_last(spark, folder):
    return _landed_load(spark, folder, catalog.REPLACE_LAST, ["x", "y"])


@query("landed_insert_absent", _LANDED_SQL + """SELECT "entryNo", status, total, "Entity" FROM t
UNION ALL SELECT "entryNo", 'x', total, "Entity" FROM n WHERE order_date >= '1999-01-01'""")
def landed_insert_absent(spark, folder):
    return _landed_load(spark, folder, catalog.INSERT_ABSENT, ["x", "y"])


KINDS = [
    catalog.APPEND, catalog.APPEND_MERGE, catalog.MERGE, catalog.REPLACE_ALL, catalog.REPLACE_LAST, catalog.INSERT_ABSENT, catalog.REFRESH,
]


@query("load_check_by_kind", f"""
WITH {DOCUMENTS_SQL},
t AS (SELECT * FROM o WHERE order_date < '1999-01-01' AND "entryNo" > 0),
n AS (SELECT *, "entryNo" IN (SELECT "entryNo" FROM t) AS known FROM o WHERE order_date >= '1998-01-01'),
w AS (SELECT "Entity", max("entryNo") AS top FROM t GROUP BY "Entity"),
a AS (SELECT n.* FROM n LEFT JOIN w ON w."Entity" = n."Entity" WHERE n."entryNo" > coalesce(top, 0)),
b AS (
  SELECT 'append above watermark' AS kind, "Entity", "entryNo", NOT known AS fresh, FALSE AS old, 1 AS held FROM a
  UNION ALL SELECT 'merge above watermark', "Entity", "entryNo", NOT known, known, 1 FROM a
  UNION ALL SELECT 'merge', "Entity", "entryNo", NOT known, known, 1 FROM n
  UNION ALL SELECT 'replace, keep repeats', "Entity", "entryNo", NOT known, known, 1 FROM n
  UNION ALL SELECT 'replace, last wins', "Entity", "entryNo", NOT known, known, 1 FROM n
  UNION ALL SELECT 'insert if absent', "Entity", "entryNo", NOT known, FALSE, 1 FROM n
  UNION ALL SELECT 'refresh', "Entity", "entryNo", TRUE, FALSE, 1 FROM n),
l AS (SELECT *, "Entity" IN ('NATION_1', 'NATION_2') AND "entryNo" % 5 = 0 AS lost, "Entity" = 'NATION_3' AND "entryNo" % 7 = 0 AS wrong FROM b)
SELECT kind, "Entity", count(*) AS pulled,
       CASE WHEN kind = 'refresh' THEN count(*) FILTER (WHERE NOT lost) ELSE count(*) FILTER (WHERE fresh) END AS inserted,
       count(*) FILTER (WHERE old) AS updated, count(*) FILTER (WHERE NOT lost) AS found,
       CASE WHEN bool_or(lost) OR (kind <> 'refresh' AND bool_or(wrong)) THEN 'Error' ELSE 'Success' END AS status
FROM l GROUP BY kind, "Entity"
""")
def load_check_by_kind(spark, folder):
    """Every kind of load, judged by what the table holds afterwards. Behind the load's back two companies lose
    every fifth number, and a third one's rows get another status."""
    rows = documents(spark, folder).withColumns({"page_no": F.lit(1), "pos": F.col("entryNo")})
    shape = ["entryNo", "status", "total", "Entity"]
    old = written_once(rows.where("order_date < '1999-01-01' and entryNo > 0").select(*shape), "old")
    new = rows.where("order_date >= '1998-01-01'").withColumn("status", F.lit("x")).select(*shape, "page_no", "pos")
    lost = F.col("Entity").isin("NATION_1", "NATION_2") & (F.col("entryNo") % 5 == 0)
    wrong = (F.col("Entity") == "NATION_3") & (F.col("entryNo") % 7 == 0)
    found = []
    for kind in KINDS:
        name = f"checked_{uuid.uuid4().hex}"
        tables.create(spark, name, old.schema, run_folder(spark, "table"))
        tables.refresh(old, name)
        entry = catalog.Dataset("documents", "orders", kind, keys=("entryNo", "Entity"), entry_no="entryNo")
        batch = extract.batch_of(entry, new, name, "2001-01-01")
        refresh = kind == catalog.REFRESH
        before = None if refresh else written_once(effects.expected(entry, batch, name), "expected")
        marks = written_once(extract.marks_of(entry, spark, name), "marks") if kind == catalog.APPEND else None
        extract.apply(entry, batch, name)
        hit = spark.table(name).where("Entity in ('NATION_1', 'NATION_2', 'NATION_3')").where(~lost)
        tables.replace_companies(written_once(hit.withColumn("status", F.when(wrong, "?").otherwise(F.col("status"))), "hit"), name)
        if refresh:
            told = run_log.load_check(batch, spark.table(name).join(batch.select("Entity").distinct(), "Entity", "left_semi"))
            told = told.select("Entity", "pulled", "inserted", F.lit(0).cast("long").alias("updated"), F.col("inserted").alias("found"), "status")
        else:
            told = effects.load_check(before, effects.seen(entry, batch, name, marks)).drop("rows")
        found.append(told.withColumn("kind", F.lit(kind)))
    return load.fan_out(found)


@query("tagged_pulls", """
SELECT c_custkey AS no, c_name AS name, CASE WHEN c_acctbal < 0 THEN 'debtors' ELSE 'others' END AS "Entity" FROM customer
""")
def tagged_pulls(spark, folder):
    """One pull per company, each tagged with its company."""
    customer = read(spark, folder, "customer").select(F.col("c_custkey").alias("no"), F.col("c_name").alias("name"), "c_acctbal")
    pulls = [("debtors", "c_acctbal < 0"), ("others", "c_acctbal >= 0")]
    return load.fan_out([binding.tagged(customer.where(c).drop("c_acctbal"), company) for company, c in pulls])


@query("logged_extracts", f"""
WITH {DOCUMENTS_SQL},
c AS (SELECT o.*, top FROM o LEFT JOIN
       (SELECT "Entity", max("entryNo") AS top FROM o WHERE order_date < '1999-01-01' GROUP BY "Entity") w
       ON w."Entity" = o."Entity")
SELECT 'BC_bankledger' AS "Name", 'Success' AS "Status", count(*) AS records, "Entity" AS company_name
FROM o WHERE order_date < '1999-01-01' AND "entryNo" > 0 GROUP BY "Entity"
UNION ALL
SELECT 'BC_bankledger', 'Success', count(*), "Entity" FROM c WHERE "entryNo" > coalesce(top, 0) GROUP BY "Entity"
UNION ALL
SELECT DISTINCT 'BC_wmsRecordLink', 'Error', -1, "Entity" FROM o
""")
def logged_extracts(spark, folder):
    """Two ledger runs and a merge that fails on repeated keys, company by company in the run log."""
    name, log = f"ledger_{uuid.uuid4().hex}", run_folder(spark, "runlog")
    landed = documents(spark, folder).select(
        F.col("entryNo").alias("Entry_No"), "total", "order_date", "Entity"
    )
    tables.create(spark, name, landed.schema, run_folder(spark, "table"))
    ledger = catalog.dataset("BC_bankledger")
    old = landed.where("order_date < '1999-01-01'")
    extract.logged_run(ledger, old, name, "2001-01-01", log)
    extract.logged_run(ledger, landed, name, "2001-01-01", log)
    links = f"links_{uuid.uuid4().hex}"
    repeated = landed.select(
        F.lit(1).alias("id"), F.lit(122).alias("tableNo"),
        F.lit("2001-01-01").cast("date").alias("created"), "total", "Entity",
    )
    tables.create(spark, links, repeated.schema, run_folder(spark, "table"))
    try:
        extract.logged_run(catalog.dataset("BC_wmsRecordLink"), repeated, links, "2001-01-01", log)
    except Exception as refused:  # the log row is what this query shows
        assert "repeats key" in str(refused)
    records = F.coalesce("RecordsInserted", F.lit(-1)).alias("records")
    return spark.read.parquet(log).select("Name", "Status", records, "company_name")


@query("reload_lines", f"""
WITH {ENTRIES_SQL}
SELECT concat(l_orderkey, '-', l_linenumber) AS id, "Entity", l_returnflag AS type,
       l_extendedprice AS amount
FROM e WHERE l_returnflag IN ('A', 'R')
""")
def reload_lines(spark, folder):
    """Full-reload repair of lines, with the kinds the regular load keeps."""
    name = f"lines_{uuid.uuid4().hex}"
    rows = entries(spark, folder).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("l_returnflag").alias("type"), F.col("l_extendedprice").alias("amount"), "Entity",
    )
    tables.create(spark, name, rows.schema, run_folder(spark, "table"))
    extract.reload(rows, name, "type IN ('A', 'R')")
    return spark.table(name).select("id", "Entity", "type", "amount")


@query("snapshot_append", """
SELECT '2024-01-01 06:00:00' AS snapshot_ts, p_partkey AS no, p_name AS name, p_retailprice AS price
FROM part WHERE p_size >= 25
UNION ALL
SELECT '2024-01-02 06:00:00', p_partkey, p_name, p_retailprice FROM part
""")
def snapshot_append(spark, folder):
    """Two runs append their whole pull under their own time."""
    store = run_folder(spark, "snapshots")
    part = read(spark, folder, "part")
    pulled = part.select(
        F.col("p_partkey").alias("no"), F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"), "p_size",
    )
    first = pulled.where("p_size >= 25").drop("p_size")
    second = pulled.drop("p_size")
    for rows, at in ((first, "2024-01-01 06:00:00"), (second, "2024-01-02 06:00:00")):
        files.append_snapshot(binding.stamped(rows, moment(at)), store)
    stored = spark.read.parquet(store)
    at = F.date_format("snapshot_ts", "yyyy-MM-dd HH:mm:ss")
    return stored.select(at.alias("snapshot_ts"), "no", "name", "price")


@query("registry_skip", """
SELECT n_name AS name, 'exact' AS rule FROM nation WHERE n_name || ' ' NOT IN ('NATION_3', 'NATION_7 ')
UNION ALL
SELECT n_name, 'blanks ignored' FROM nation WHERE rtrim(n_name || ' ') NOT IN ('NATION_3', 'NATION_7')
""")
def registry_skip(spark, folder):
    """Registered names end in a blank here; only one rule sees through it."""
    blank = registry(spark, folder).select(F.concat("name", F.lit(" ")).alias("name"))
    skip = ["NATION_3", "NATION_7 "]
    exact = company_names(blank, skip).withColumn("rule", F.lit("exact"))
    trimmed = company_names(blank, skip, ignore_trailing_blanks=True).withColumn(
        "rule", F.lit("blanks ignored")
    )
    return exact.unionByName(trimmed).withColumn("name", no_trailing_blanks(F.col("name")))


@query("status_extract", """
SELECT c_custkey AS no, c_mktsegment AS "statusCode3PL", n_name AS "Entity"
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT s_suppkey, NULL, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def status_extract(spark, folder):
    customers = read(spark, folder, "customer").join(
        customer_companies(spark, folder).select("c_custkey", "Entity"), "c_custkey"
    ).select(F.col("c_custkey").alias("no"), F.col("c_mktsegment").alias("statusCode3PL"), "Entity")
    vendors = supplier_companies(spark, folder).select(
        F.col("s_suppkey").alias("no"), F.lit(None).cast("string").alias("statusCode3PL"), "Entity"
    )
    return extract.status_extract(customers).unionByName(extract.status_extract(vendors))
