"""Readers, binding and scalar expressions, on landed copies of the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F, types as T

from ledgerhub.functions import money as m
from ledgerhub.functions import rules, text, times
from ledgerhub.operators import binding, inference
from ledgerhub.plans import catalog, extract
from ledgerhub.scratch import run_folder
from ledgerhub.sinks import files, tables
from ledgerhub.sources import counts, pages, registry, reports, warehouse
from ledgerhub.warehouse_queries.base import (
    DOCUMENTS_SQL, documents, moment, money, plain, query, read,
)

PAGE_SIZE = 2


RECORD = T.StructType().add("turn", "long").add("role", "string").add("text", "string").add("note", "string")


def _landed_pages(spark, folder):
    """Conversations as page chains, one page per line.

    A conversation that ends with a question is an unfinished pull: its last page still
    names a next one.
    """
    turns = read(spark, folder, "conversations")
    ends = turns.groupBy("conv_id").agg(
        F.max("turn").alias("last_turn"), F.max_by("role", "turn").alias("last_role")
    )
    number = F.floor(F.col("turn") / PAGE_SIZE) + 1
    grouped = (
        turns.join(ends, "conv_id")
        .groupBy("conv_id", number.alias("page_no"), "last_turn", "last_role")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("value"))
    )
    last = F.col("page_no") == F.floor(F.col("last_turn") / PAGE_SIZE) + 1
    link = F.when(~last | (F.col("last_role") == "user"), F.format_string("?page=%d", F.col("page_no") + 1))
    store = run_folder(spark, "pages")
    grouped.select(
        F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("Entity"), "page_no", "value",
        link.alias(pages.NEXT_LINK),
    ).write.json(store)
    return pages.read_pages(spark, store, RECORD)


_CHAINS_SQL = f"""
WITH c AS (SELECT conv_id, max(turn) AS last_turn, arg_max(role, turn) AS last_role FROM conversations GROUP BY conv_id)
"""


@query("json_pages", _CHAINS_SQL + f"""
SELECT 'C' || conv_id AS "Entity", turn // {PAGE_SIZE} + 1 AS page_no,
       CAST(row_number() OVER (PARTITION BY conv_id, turn // {PAGE_SIZE} ORDER BY turn) - 1 AS INTEGER) AS pos,
       turn, role, text, CAST(NULL AS VARCHAR) AS note
FROM conversations JOIN c USING (conv_id) WHERE last_role <> 'user'
""")
def json_pages(spark, folder):
    """Records of companies whose page chain is whole; a field that never landed is NULL."""
    return extract.landed_records(_landed_pages(spark, folder))[0]


@query("json_page_rejects", _CHAINS_SQL + f"""
SELECT 'C' || conv_id AS "Entity", last_turn // {PAGE_SIZE} + 1 AS pages FROM c WHERE last_role = 'user'
""")
def json_page_rejects(spark, folder):
    return extract.landed_records(_landed_pages(spark, folder))[1]


def _landed_companies(spark, folder, text):
    """Conversations of 25 companies as page chains, a page for each, without unfinished ones."""
    company = F.concat(F.lit("C"), (F.col("conv_id") % 25).cast("string"))
    turns = read(spark, folder, "conversations").withColumns({"Entity": company, "text": text})
    value = F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("value")
    grouped = turns.groupBy("Entity", "conv_id").agg(value)
    order = Window.partitionBy("Entity").orderBy("conv_id")
    placed = grouped.withColumns({"page_no": F.row_number().over(order), "more": F.lead("conv_id").over(order)})
    return placed.select("Entity", "page_no", "value", F.when(F.col("more").isNotNull(), "next").alias(pages.NEXT_LINK))


@query("refresh_keeps_rejected", """
SELECT 'C' || conv_id % 25 AS "Entity", turn, role,
       CASE WHEN conv_id % 5 = 1 THEN text ELSE upper(md5(text)) END AS text
FROM conversations WHERE conv_id % 5 NOT IN (3, 4)
""")
def refresh_keeps_rejected(spark, folder):
    """Two pulls of a refreshed table, read back. By the last digit of their number, modulo 5:

    1: the second pull is unfinished, the rows of the first stay; 3: no longer registered, not
    pulled, gone; 4: the second pull is whole and empty, nothing stays; others are replaced.
    """
    entry, name, log = catalog.dataset("BC_Customers"), f"pulled_{uuid.uuid4().hex}", run_folder(spark, "log")
    schema = T.StructType([f for f in RECORD.fields if f.name != "note"])
    stored = T.StructType([*schema.fields, T.StructField("Entity", T.StringType())])
    tables.create(spark, name, stored, run_folder(spark, "table"))
    kind = F.substring("Entity", 2, 9).cast("int") % 5
    first = _landed_companies(spark, folder, F.col("text"))
    second = _landed_companies(spark, folder, F.upper(F.md5("text"))).where(kind != 3)
    link = F.when(kind == 1, "next").when(kind != 4, F.col(f"`{pages.NEXT_LINK}`"))
    none = F.array().cast(second.schema["value"].dataType)
    second = second.where((kind != 4) | (F.col("page_no") == 1)).withColumns({
        pages.NEXT_LINK: link, "value": F.when(kind == 4, none).otherwise(F.col("value")),
    })
    registered = first.where(kind != 3).select("Entity").distinct()
    for landed, names in ((first, None), (second, registered)):
        store = run_folder(spark, "pages")
        landed.write.json(store)
        extract.run_landed(spark, entry, store, name, "2001-01-01", log, schema=schema, registered=names)
    return spark.table(name).select("Entity", "turn", "role", "text")


@query("count_answers", """
SELECT event_type AS "Entity", CASE WHEN event_type <> 'error' THEN CAST(count(*) AS VARCHAR) END AS source_rows
FROM events GROUP BY event_type
""")
def count_answers(spark, folder):
    """Count answers landed as text; an error page has no number."""
    counted = read(spark, folder, "events").groupBy(F.col("event_type").alias("Entity")).agg(
        F.count(F.lit(1)).alias("n")
    )
    answer = F.when(F.col("Entity") == "error", "not available").otherwise(
        F.concat(F.lit("﻿"), F.col("n").cast("string"), F.lit(" "))
    )
    store = run_folder(spark, "counts")
    counted.select("Entity", answer.alias("value")).write.partitionBy("Entity").text(store)
    return counts.read_counts(spark, store).withColumn(
        "source_rows", F.col("source_rows").cast("string")
    )


@query("csv_by_position", """
SELECT o_orderkey AS "entryNo", o_orderstatus || ', "' || o_orderpriority || '"' AS remark,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, strftime(o_orderdate, '%Y-%m-%d') AS posted
FROM orders
""")
def csv_by_position(spark, folder):
    """A report whose header is discarded: fields by position, then typed by name."""
    store = run_folder(spark, "report")
    read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("x"),
        F.concat(F.col("o_orderstatus"), F.lit(', "'), F.col("o_orderpriority"), F.lit('"')).alias("y"),
        money("o_totalprice").alias("z"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("w"),
    ).write.option("header", True).option("escape", '"').csv(store)
    landed = binding.positional(
        reports.positional_report(spark, store, 4), ["ENTRYNO", "remark", "amount", "posted"]
    )
    schema = (
        T.StructType().add("entryNo", "long").add("remark", "string")
        .add("amount", T.DecimalType(18, 2)).add("posted", "date")
    )
    bound = binding.bind(landed, schema)
    return bound.withColumns(
        {"amount": plain("amount"), "posted": F.date_format("posted", "yyyy-MM-dd")}
    )


@query("csv_by_name", """
SELECT event_id, user_id, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value,
       CAST(NULL AS VARCHAR) AS remark FROM events
""")
def csv_by_name(spark, folder):
    """A ``;`` report bound by header names in another order, one column missing."""
    store = run_folder(spark, "report")
    read(spark, folder, "events").select(
        "event_type", money("value").alias("VALUE"), "user_id", "event_id", "props"
    ).write.option("header", True).option("sep", ";").option("escape", '"').csv(store)
    landed = reports.named_report(spark, store, separator=";")
    schema = (
        T.StructType().add("event_id", "long").add("user_id", "long").add("event_type", "string")
        .add("value", T.DecimalType(18, 2)).add("remark", "string")
    )
    return binding.bind(landed, schema).withColumn("value", plain("value"))


@query("report_refresh", """
SELECT CAST(o_orderkey AS VARCHAR) AS "_c1", CAST(o_custkey AS VARCHAR) AS "_c2", 'closed' AS "_c3",
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "_c4", strftime(o_orderdate, '%Y-%m-%d') AS "_c5",
       'A' AS "_c6"
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
""")
def report_refresh(spark, folder):
    """A voyage report of six columns replaces the stored table; the job keeps settled voyages."""
    store = run_folder(spark, "report")
    read(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("SnapShotType"),
        money("o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "A").otherwise("F").alias("DataType"),
    ).write.option("header", True).csv(store)
    entry = catalog.dataset("VS_voyagev3")
    landed = extract.landed_report(spark, entry, store)
    name = f"voyages_{uuid.uuid4().hex}"
    tables.create_plain(spark, name, landed.schema, run_folder(spark, "table"))
    extract.run(entry, landed, name, "2001-01-01")
    return spark.table(name)


@query("settled_voyages", """
SELECT o_orderkey AS voyage FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
""")
def settled_voyages(spark, folder):
    voyages = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("voyage"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "A").otherwise("F").alias("DataType"),
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("SnapShotType"),
    )
    return reports.settled_voyages(voyages).select("voyage")


@query("mapping_import", """
SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS "Ledgernummer" FROM part
""")
def mapping_import(spark, folder):
    """One column of a landed mapping list; numbers keep their leading zeros."""
    store = run_folder(spark, "mapping")
    read(spark, folder, "part").select(
        F.col("p_name").alias("Omschrijving"),
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("Ledgernummer"),
    ).write.option("header", True).csv(store)
    return reports.mapping_keys(reports.named_report(spark, store), "Ledgernummer")


@query("mapping_load", """
SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS "Ledgernummer" FROM part WHERE p_size > 10
""")
def mapping_load(spark, folder):
    """The stored mapping list is replaced by the landed one, then read back."""
    entry, name = catalog.dataset("BC_GLaccounts_mapping"), f"mapping_{uuid.uuid4().hex}"
    number = F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("Ledgernummer")
    for condition in ("p_size <= 10", "p_size > 10"):
        store = run_folder(spark, "mapping")
        read(spark, folder, "part").where(condition).select(F.col("p_name").alias("Omschrijving"), number).write.option(
            "header", True).csv(store)
        landed = reports.mapping_keys(reports.named_report(spark, store), "Ledgernummer")
        tables.create_plain(spark, name, landed.schema, run_folder(spark, "table"))
        extract.run(entry, landed, name, "2001-01-01")
    return warehouse.read_table(spark, name)


@query("registry_tables", """
SELECT CASE WHEN n_regionkey % 2 = 0 THEN 'first' ELSE 'second' END AS registry, n_name AS name
FROM nation WHERE n_name <> 'NATION_3'
""")
def registry_tables(spark, folder):
    """Names from two stored registries, one company left out."""
    found = []
    for name, rest in (("first", 0), ("second", 1)):
        table = f"companies_{uuid.uuid4().hex}"
        rows = read(spark, folder, "nation").where(F.col("n_regionkey") % 2 == rest).select(F.col("n_name").alias("name"))
        tables.create_plain(spark, table, rows.schema, run_folder(spark, "table"))
        tables.swap(rows, table)
        names = registry.read_companies(spark, table, skip=["NATION_3"])
        found.append(names.select(F.lit(name).alias("registry"), "name"))
    return found[0].unionByName(found[1])


@query("staging_scan", """
SELECT o_orderstatus AS status, count(*) AS documents FROM orders GROUP BY o_orderstatus
""")
def staging_scan(spark, folder):
    """A query over a stored table of a named database."""
    table = f"staged_{uuid.uuid4().hex}"
    rows = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    tables.create_plain(spark, table, rows.schema, run_folder(spark, "table"))
    tables.swap(rows, table)
    scanned = warehouse.read_table(spark, table, "default")
    return scanned.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("documents"))


@query("drift_report", """
SELECT 'missing' AS problem, 'searchName' AS "column", CAST(0 AS BIGINT) AS filled
UNION ALL SELECT 'unknown', 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment <> 'BUILDING') FROM customer
UNION ALL SELECT 'unknown', 'c_nationkey', count(c_nationkey) FROM customer
""")
def drift_report(spark, folder):
    """Declared columns that did not land and landed ones that are not declared, with their filled rows."""
    landed = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("NO"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"), "c_nationkey",
    )
    schema = T.StructType().add("no", "long").add("name", "string").add("balance", "double").add("searchName", "string")
    return binding.drift_rows(landed, schema)


LINE_RECORDS = 500


def _land_texts(rows, store):
    """Records given as JSON text, as page chains of their company, a page per line.

    Pages have LINE_RECORDS records on average, so their number grows with the rows.
    """
    sized = rows.groupBy("Entity").agg(F.ceil(F.count(F.lit(1)) / LINE_RECORDS).alias("n"))
    paged = rows.join(sized, "Entity").withColumn("page", F.pmod(F.xxhash64("record"), "n"))
    lists = paged.groupBy("Entity", "page").agg(F.concat_ws(", ", F.sort_array(F.collect_list("record"))).alias("list"))
    order = Window.partitionBy("Entity").orderBy("page")
    placed = lists.withColumns({"place": F.row_number().over(order), "more": F.lead("page").over(order)})
    line = F.format_string(
        '{"Entity": "%s", "page_no": %d, "value": [%s]%s}', "Entity", "place", "list",
        F.when(F.col("more").isNull(), "").otherwise(f', "{pages.NEXT_LINK}": "next"'))
    placed.select(line.alias("value")).write.text(store)


def _json(**columns):
    """JSON text of a record; columns are JSON values as text, NULL leaves the field out."""
    parts = [F.concat(F.lit(f'"{name}": '), value) for name, value in columns.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def _text(column):
    return F.concat(F.lit('"'), column, F.lit('"'))


#: The kinds of value that a column of the records has, by order status: the type must hold them all.
_INFERRED_SQL = """
SELECT 'entryNo' AS "column", 'bigint' AS type, count(*) AS filled FROM orders
UNION ALL SELECT 'No', 'string', count(*) FROM orders
UNION ALL SELECT 'total', 'decimal(' || greatest(18, max(length(CAST(floor(o_totalprice) AS BIGINT)::VARCHAR)) + 2) || ',2)', count(*) FROM orders
UNION ALL SELECT 'status', 'string', count(*) FROM orders
UNION ALL SELECT 'posted', 'date', count(*) FROM orders
UNION ALL SELECT 'changed', CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0 THEN 'timestamp' ELSE 'date' END, count(*) FROM orders
UNION ALL SELECT 'blocked', 'boolean', count(*) FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'quantity', CASE WHEN count(*) FILTER (WHERE o_orderstatus <> 'O') > 0 THEN 'decimal(18,3)' ELSE 'bigint' END, count(*) FROM orders
UNION ALL SELECT 'share', 'double', count(*) FROM orders
UNION ALL SELECT 'mixed', CASE count(DISTINCT o_orderstatus = 'P') WHEN 2 THEN 'string' ELSE 'bigint' END, count(*) FROM orders
UNION ALL SELECT 'badDay', 'string', count(*) FROM orders
UNION ALL SELECT 'never', 'string', 0
"""


@query("inferred_schema", _INFERRED_SQL)
def inferred_schema(spark, folder):
    """Columns of records that nobody declared: profiles of two pulls, merged, and the type of each."""
    status = F.col("o_orderstatus")
    number = F.col("o_orderkey").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    record = _json(
        entryNo=number, No=_text(F.lpad(number, 9, "0")), total=money("o_totalprice").cast("string"), status=_text(status),
        posted=_text(day), changed=_text(F.when(status == "F", F.concat(day, F.lit("T08:00:00Z"))).otherwise(day)),
        blocked=F.when(status != "P", (F.col("o_orderkey") % 2 == 0).cast("string")),
        quantity=F.when(status == "O", F.col("o_custkey").cast("string")).otherwise(
            F.concat((F.col("o_custkey") % 100000).cast("string"), F.lit(".125"))),
        share=F.concat((F.col("o_orderkey") % 7 + 1).cast("string"), F.lit(".5E3")),
        mixed=F.when(status == "P", F.lit("true")).otherwise(number),
        badDay=_text(F.when(F.col("o_orderkey") % 2 == 0, F.lit("2024-02-31")).otherwise(day)), never=F.lit("null"),
    )
    rows = read(spark, folder, "orders").select(
        F.concat(F.lit("C"), (F.col("o_custkey") % 25).cast("string")).alias("Entity"), record.alias("record"), "o_orderkey")
    profiles = []
    for condition in ("o_orderkey % 3 = 0", "o_orderkey % 3 <> 0"):
        store = run_folder(spark, "pages")
        _land_texts(rows.where(condition).drop("o_orderkey"), store)
        profiles.append(inference.profile(pages.fields(pages.read_pages(spark, store, pages.RAW))))
    return inference.typed(inference.merged(profiles))


@query("landed_inferred", """
SELECT "Entity", no, name, balance, blocked FROM (
  SELECT 'C' || c_nationkey AS "Entity", lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS no, c_name AS name,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) + CASE WHEN c_nationkey % 5 = 1 THEN 0 ELSE 1 END AS DOUBLE) AS balance,
         CASE WHEN c_nationkey % 5 <> 1 AND c_custkey % 3 = 0 THEN NULL ELSE c_acctbal < 0 END AS blocked
  FROM customer)
""")
def landed_inferred(spark, folder):
    """A job without declared columns, pulled twice: the first pull makes the table, the second one has an
    unfinished chain for every fifth company, a new field, and text where flags were."""
    entry, name, log = catalog.dataset("BC_Services"), f"inferred_{uuid.uuid4().hex}", run_folder(spark, "log")
    number, table_store = F.col("c_custkey"), run_folder(spark, "table")
    kept = F.col("c_nationkey") % 5 == 1

    def pull(extra, flag, more):
        record = _json(
            no=_text(F.lpad(number.cast("string"), 8, "0")), name=_text(F.col("c_name")),
            balance=(money("c_acctbal") + extra).cast("string"), blocked=flag, **more)
        store = run_folder(spark, "pages")
        _land_texts(read(spark, folder, "customer").select(
            F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("Entity"), record.alias("record")), store)
        return store

    flag = (F.col("c_acctbal") < 0).cast("string")
    first = pull(F.lit(0), flag, {})
    second = pull(F.lit(1), F.when(~kept & (number % 3 == 0), F.lit('"maybe"')).otherwise(flag), {"fax": F.lit('"1"')})
    unfinished = spark.read.text(second).select(F.when(
        F.regexp_extract("value", r'"Entity": "C(\d+)"', 1).cast("int") % 5 == 1,
        F.concat(F.expr("left(value, length(value) - 1)"), F.lit(f', "{pages.NEXT_LINK}": "more"}}'))).otherwise(
        F.col("value")).alias("value"))
    cut = run_folder(spark, "pages")
    unfinished.write.text(cut)
    for store in (first, cut):
        extract.run_inferred(spark, entry, store, name, "2001-01-01", log, table_store)
    return spark.table(name).select("Entity", "no", "name", plain("balance").alias("balance"), "blocked")


@query("bind_by_name", """
SELECT c_custkey AS no, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance,
       md5(c_name) AS etag, c_mktsegment AS "3PL_Vendor_No", CAST(NULL AS VARCHAR) AS "searchName",
       CAST(NULL AS VARCHAR) AS segment_no FROM customer
""")
def bind_by_name(spark, folder):
    """Escaped and bracketed names, other case, a missing column and one that cannot be read."""
    landed = read(spark, folder, "customer").select(
        F.md5("c_name").alias("[@odata.etag]"), F.col("c_mktsegment").alias("_x0033_PL_Vendor_No"),
        F.col("c_custkey").cast("string").alias("[No]"), F.col("c_name").alias("NAME"),
        F.col("c_acctbal").cast("string").alias("Balance"), F.col("c_nationkey").alias("foo"),
        F.col("c_mktsegment").alias("segment_no"),
    )
    schema = (
        T.StructType().add("no", "long").add("name", "string").add("balance", T.DecimalType(18, 2))
        .add("ODataEtag", "string").add("3PL_Vendor_No", "string").add("searchName", "string")
        .add("segment_no", "long")
    )
    bound = binding.with_plain_names(binding.bind(landed, schema))
    return bound.withColumns(
        {"balance": plain("balance"), "segment_no": F.col("segment_no").cast("string")}
    )


@query("scalar_texts", r"""
SELECT doc_id,
  CASE WHEN lang <> 'de' THEN source END AS key_prefix,
  CASE WHEN text <> '' THEN md5(list_extract(string_split(text, '-'), -1)) END AS last_token,
  CAST(TRY_CAST(regexp_extract(text, '(\d+)', 1) AS BIGINT) AS VARCHAR) AS first_number,
  upper(source) AS upper_source,
  rtrim(source || '  ') AS trimmed,
  CASE lang WHEN 'de' THEN 'EU' WHEN 'fr' THEN 'EU' WHEN 'es' THEN 'EU' ELSE 'EXPORT' END AS country_group,
  'https://erp.example/?company=' || source || '&page=1' AS link
FROM documents
""")
def scalar_texts(spark, folder):
    """Text expressions over whole documents."""
    key = F.when(F.col("lang") == "de", F.col("source")).otherwise(F.concat_ws("|", "source", "lang", "doc_id"))
    code = F.upper("lang")
    return read(spark, folder, "documents").select(
        "doc_id",
        text.key_prefix(key).alias("key_prefix"),
        F.md5(text.last_token(F.col("text"))).alias("last_token"),
        text.first_number(F.col("text")).cast("string").alias("first_number"),
        F.upper("source").alias("upper_source"),
        text.no_trailing_blanks(F.concat(F.col("source"), F.lit("  "))).alias("trimmed"),
        rules.country_group(code).alias("country_group"),
        text.deep_link("https://erp.example/?company=", F.col("source"), "&page=1").alias("link"),
    )


@query("scalar_times", r"""
WITH x AS (SELECT event_id, ts, value, event_type, regexp_extract(props, '(\d+)', 1) AS k FROM events)
SELECT event_id,
  CASE WHEN event_type = 'click' THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS minute_day,
  CASE WHEN CAST(k AS INTEGER) BETWEEN 1 AND 12 THEN '2024-' || lpad(k, 2, '0') || '-05' END AS strict_day,
  strftime(ts, '%Y-%m-%d') AS iso_day,
  CAST(date_sub('minute', ts, TIMESTAMP '2024-02-01 00:00:00') AS INTEGER) AS minutes,
  CASE WHEN event_type = 'view' THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS day_text,
  CASE WHEN event_type <> 'signup' THEN strftime(ts, '%Y-%m-%d')
         || CASE WHEN event_type = 'error' THEN ' 00:00:00' ELSE ' 09:45:00' END END AS stamp,
  CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS two_decimals,
  CASE event_type WHEN 'click' THEN '19200' WHEN 'view' THEN '19300' END AS ledger,
  strftime(CAST(ts AS DATE) - INTERVAL 7 DAY, '%Y-%m-%d') AS week_before
FROM x
""")
def scalar_times(spark, folder):
    """Dates, times and amounts as text; what does not parse is NULL or empty."""
    events = read(spark, folder, "events").withColumn("k", F.regexp_extract("props", r"(\d+)", 1))
    kind, ts = F.col("event_type"), F.col("ts")
    stamp_text = F.when(kind == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(ts, "yyyy-MM-dd HH:mm")
    )
    day = F.when(kind == "signup", F.lit("1753-01-01").cast("date")).otherwise(ts.cast("date"))
    clock = F.when(kind != "error", "09:45:00")
    currency = F.when(kind == "click", "EUR").when(kind == "view", "GBP").otherwise("XXX")
    return events.select(
        "event_id",
        times.minute_stamp_day(stamp_text).alias("minute_day"),
        F.date_format(times.strict_date(F.concat(F.lit("2024-"), "k", F.lit("-5"))), "yyyy-MM-dd").alias("strict_day"),
        times.iso_day(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("iso_day"),
        times.whole_minutes(ts, moment("2024-02-01 00:00:00")).alias("minutes"),
        times.day_text(F.when(kind != "view", ts)).alias("day_text"),
        F.date_format(times.real_time(day, clock), "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        m.two_decimals(F.col("value")).alias("two_decimals"),
        rules.currency_ledger(currency).cast("string").alias("ledger"),
        F.date_format(times.days_before(ts.cast("date"), 7), "yyyy-MM-dd").alias("week_before"),
    )


@query("report_files", f"""
WITH {DOCUMENTS_SQL}
SELECT "Entity", CAST("entryNo" AS VARCHAR) AS "entryNo", priority FROM o WHERE status = 'P'
""")
def report_files(spark, folder):
    """Report written as CSV per company and read back."""
    store = run_folder(spark, "reports")
    files.write_report(
        documents(spark, folder).where("status = 'P'").select("entryNo", "priority", "Entity"), store
    )
    return reports.named_report(spark, store).select("Entity", F.col("entryNo").cast("string").alias("entryNo"), "priority")
