"""Payment matching and port-call documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerhub.fixed_values import (
    PORTCALL_NAMESPACE, PURCHASE_KIND, SALES_KIND, SOAP_HEAD, SOAP_TAIL,
)
from ledgerhub.functions.rules import payment_company, invoice_kind
from ledgerhub.plans import payments, portcalls
from ledgerhub.scratch import run_folder
from ledgerhub.sinks import files
from ledgerhub.warehouse_queries.base import money, query, read


def _transaction():
    fragment = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "XVLIE")
        .when(F.col("o_orderpriority") == "2-HIGH", "HNV")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "COA")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "MAAS")
        .otherwise("ZZZ")
    )
    return F.concat(fragment, F.col("o_orderkey").cast("string"))


def _invoice_no():
    """Numbers that start with 1 or 2 tell the kind; every seventh order's has letters."""
    sales = F.when(F.col("o_orderstatus") == "O", "1").otherwise("2")
    letters = F.when(F.col("o_orderkey") % 7 == 0, "AB").otherwise("")
    return F.concat(sales, letters, F.col("o_orderkey").cast("string"))


def _currency():
    return (
        F.when(F.col("o_orderstatus") == "F", "EUR")
        .when(F.col("o_orderstatus") == "P", "JPY")
        .otherwise("USD")
    )


def _open_invoices(spark, folder):
    return payments.routed(
        read(spark, folder, "orders").select(
            _transaction().alias("ExactTransNo"), _invoice_no().alias("Invoice No"),
            _currency().alias("Curr"), money("o_totalprice").alias("Amount Curr"),
        )
    )


def _headers(spark, folder):
    """Line items as posted headers; the amount is sometimes near, sometimes far."""
    orders = read(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"
    )
    lineitem = read(spark, folder, "lineitem")
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    booked = (
        F.when(F.col("l_returnflag") == "A", money("o_totalprice") + F.lit("0.01").cast("decimal(18,2)"))
        .when(F.col("l_returnflag") == "R", money("o_totalprice") + F.lit("0.02").cast("decimal(18,2)"))
        .otherwise(money("l_extendedprice"))
    )
    # a rate of ten decimals and more; missing or zero for some parts
    long = (F.lit("0.923456789123").cast("decimal(20,12)") + F.col("l_discount").cast("decimal(18,2)")).cast("decimal(38,18)")
    rate = F.when(F.col("l_partkey") % 50 == 0, F.lit(0).cast("decimal(38,18)")).when(F.col("l_partkey") % 50 != 1, long)
    closed = F.when(F.col("l_linestatus") == "O", True).when(F.col("l_returnflag") == "N", False)
    return joined.select(
        payment_company(_transaction()).alias("company"),
        invoice_kind(_invoice_no()).alias("kind"),
        F.concat_ws(
            "-", F.lpad(F.col("l_partkey").cast("string"), 9, "0"),
            F.lpad(F.col("l_suppkey").cast("string"), 9, "0"),
            F.lpad((money("l_extendedprice") * 100).cast("bigint").cast("string"), 12, "0"),
            (money("l_quantity")).cast("string"),
            F.date_format("l_shipdate", "yyyyMMdd"),
        ).alias("id"),
        F.concat_ws("/", F.lpad(F.col("l_orderkey").cast("string"), 9, "0"), "l_linenumber").alias("no"),
        F.col("l_shipdate").alias("systemModifiedAt"),
        F.col("l_shipdate").cast("date").alias("postingDate"),
        F.concat_ws(
            "-", F.concat(F.lit("Invoice "), _invoice_no(), F.lit(" and "), _invoice_no(), F.lit("0")), F.lit("VS"), "l_linenumber",
        ).alias("postingDescription"),
        rate.alias("currencyFactor"),
        closed.alias("closed"),
        booked.cast("decimal(18,2)").alias("amountIncludingVAT"),
    ).where(F.col("company").isNotNull())


_PAYMENT_SQL = f"""
WITH i AS (
  SELECT o_orderkey, o_totalprice,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'XVLIE' WHEN '2-HIGH' THEN 'HNV' WHEN '3-MEDIUM' THEN 'COA'
      WHEN '4-NOT SPECIFIED' THEN 'MAAS' ELSE 'ZZZ' END || o_orderkey AS transaction,
    CASE WHEN o_orderstatus = 'O' THEN '1' ELSE '2' END || CASE WHEN o_orderkey % 7 = 0 THEN 'AB' ELSE '' END || o_orderkey AS invoice_no,
    CASE o_orderstatus WHEN 'F' THEN 'EUR' WHEN 'P' THEN 'JPY' ELSE 'USD' END AS currency,
    CAST(o_totalprice AS DECIMAL(18,2)) AS asked,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Hartel' WHEN '2-HIGH' THEN 'Chartering'
      WHEN '3-MEDIUM' THEN 'Chartering' WHEN '4-NOT SPECIFIED' THEN 'Geervliet' END AS company,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'VLIET' WHEN '2-HIGH' THEN 'HNV BV'
      WHEN '3-MEDIUM' THEN 'COASTA' WHEN '4-NOT SPECIFIED' THEN 'MAASVL' END AS company_code,
    CASE WHEN o_orderstatus = 'O' THEN '{SALES_KIND}' ELSE '{PURCHASE_KIND}' END AS kind
  FROM orders),
h AS (
  SELECT company, kind,
    lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || '-'
      || lpad(CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS VARCHAR), 12, '0') || '-'
      || CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) || '-' || strftime(l_shipdate, '%Y%m%d') AS id,
    lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || '/' || l_linenumber AS no,
    strftime(l_shipdate, '%Y-%m-%d') AS day,
    'Invoice ' || invoice_no || ' and ' || invoice_no || '0-VS-' || l_linenumber AS descr, CAST(l_linenumber AS VARCHAR) AS tail,
    CASE l_partkey % 50 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE 0.923456789123 + CAST(l_discount AS DECIMAL(18,2)) END AS factor,
    CASE WHEN l_linestatus = 'O' THEN TRUE WHEN l_returnflag = 'N' THEN FALSE END AS closed,
    CASE l_returnflag WHEN 'A' THEN asked + 0.01 WHEN 'R' THEN asked + 0.02
      ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS booked
  FROM lineitem JOIN i ON l_orderkey = o_orderkey WHERE company IS NOT NULL),
f AS (
  SELECT i.*, h.id, h.day, h.tail, h.factor, h.closed, h.booked,
    row_number() OVER (PARTITION BY i.o_orderkey ORDER BY h.no, h.id) AS place
  FROM i JOIN h ON h.company = i.company AND h.kind = i.kind AND contains(h.descr, i.invoice_no)),
c AS (
  SELECT *, CASE WHEN abs(asked - booked) <= 0.019999 THEN asked ELSE CAST(booked AS DECIMAL(18,2)) END AS chosen
  FROM f WHERE place = 1 AND coalesce(closed, TRUE)),
x AS (SELECT transaction, invoice_no, id AS "externalRefId",
        CASE WHEN factor IS NULL THEN 'exchange rate missing' ELSE 'exchange rate is zero' END AS reason
      FROM c WHERE currency <> 'EUR' AND coalesce(factor, 0) = 0),
u AS (SELECT *, CAST(chosen * 100 AS HUGEINT) * 1000000000000 AS num,
        CASE WHEN coalesce(factor, 0) = 0 THEN 1 ELSE CAST(factor * 1000000000000 AS HUGEINT) END AS den
      FROM c WHERE currency = 'EUR' OR coalesce(factor, 0) <> 0),
v AS (SELECT *, num // den AS quo, num % den AS rem FROM u),
r AS (SELECT *, quo + CASE WHEN 2 * rem > den OR (2 * rem = den AND quo % 2 = 1) THEN 1 ELSE 0 END AS cents FROM v),
p AS (
  SELECT transaction, invoice_no, tail AS "invoiceTransNo", day AS "entryDate", day AS "actDate",
    id AS "externalRefId", 'WT' AS "payMode", CAST(chosen AS VARCHAR) AS "currencyAmount", currency,
    CASE WHEN currency = 'EUR' THEN CAST(chosen AS VARCHAR)
      ELSE CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS "baseCurrencyAmount",
    CASE WHEN currency = 'EUR' THEN '1' ELSE regexp_replace(CAST(CAST(factor AS DECIMAL(18,12)) AS VARCHAR), '0+$', '') END AS "bankXCRate",
    CASE currency WHEN 'EUR' THEN '19200' WHEN 'USD' THEN '19400' END AS "bankCode",
    company_code AS "companyCode"
  FROM r)
"""


@query("payment_match", _PAYMENT_SQL + "SELECT * FROM p")
def payment_match(spark, folder):
    """Open invoices paid by the first posted header that mentions their number."""
    return payments.payments(_open_invoices(spark, folder), _headers(spark, folder))


@query("payment_rate_rejects", _PAYMENT_SQL + "SELECT * FROM x")
def payment_rate_rejects(spark, folder):
    """Settled invoices whose rate is missing or zero: they don't end the job."""
    return payments.without_rate(payments.settled(_open_invoices(spark, folder), _headers(spark, folder)))


@query("payment_rejects", """
SELECT 'ZZZ' || o_orderkey AS transaction,
  CASE WHEN o_orderstatus = 'O' THEN '1' ELSE '2' END || CASE WHEN o_orderkey % 7 = 0 THEN 'AB' ELSE '' END || o_orderkey AS invoice_no
FROM orders WHERE o_orderpriority = '5-LOW'
""")
def payment_rejects(spark, folder):
    return payments.unroutable(_open_invoices(spark, folder)).select("transaction", "invoice_no")


def _xml_sql(fields):
    parts = " || ".join(
        f"""'<{name}>' || coalesce("{name}", '') || '</{name}>'""" for name in fields
    )
    return f"'<simplePayment>' || {parts} || '</simplePayment>'"


@query("payment_xml", _PAYMENT_SQL + f"""
SELECT invoice_no AS message_id, 'payments' AS endpoint, {_xml_sql(payments.PAYMENT_FIELDS)} AS payload FROM p
""")
def payment_xml(spark, folder):
    """Payment messages through the stored outbox."""
    store = run_folder(spark, "outbox")
    paid = payments.payments(_open_invoices(spark, folder), _headers(spark, folder))
    files.append_rows(files.outbox(payments.payment_messages(paid), "payments"), store)
    return spark.read.parquet(store)


RUN_DATE = "2001-01-08"


def _portcall_inputs(spark, folder):
    """Orders are port calls, line items their history and routes, suppliers harbours."""
    lineitem, orders = read(spark, folder, "lineitem"), read(spark, folder, "orders")
    history = lineitem.select(
        F.col("l_orderkey").alias("PORTCALL_ID"), F.col("l_shipdate").cast("date").alias("CHANGE_DATE"),
        F.when(F.col("l_linestatus") == "F", "08:30:00").otherwise("17:00:00").alias("CHANGE_TIME"),
        F.when(F.col("l_returnflag") == "R", "PortCall created").otherwise("Other").alias("INFO"),
    )
    eta = F.when(F.col("o_orderstatus") == "P", F.lit("1753-01-01").cast("date")).otherwise(
        F.col("o_orderdate").cast("date")
    )
    portcall = orders.select(
        F.col("o_orderkey").alias("ID"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("SETUP_ID"),
        F.col("o_custkey").alias("VESSEL_ID"),
        F.concat(F.lit("PC"), F.col("o_orderkey").cast("string")).alias("PORTCALL_NUMBER"),
        F.when(F.col("o_orderstatus") != "F", F.lower("o_orderpriority")).alias("VOY"),
        eta.alias("ETA_DATE"), F.lit("12:00:00").alias("ETA_TIME"),
        F.col("o_orderdate").cast("date").alias("ETD_DATE"),
        F.when(F.col("o_orderstatus") == "O", "06:15:00").alias("ETD_TIME"),
    )
    agent = F.when(F.col("r_name") == "AFRICA", "Other agency").when(
        F.col("r_name").isin("AMERICA", "ASIA"), "Maripro BV"
    ).otherwise("Maripro Belgium BV")
    setup = read(spark, folder, "region").select(
        (F.col("r_regionkey") + 1).alias("ID"), agent.alias("AGENT")
    )
    vessel = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("ID"), F.col("c_name").alias("NAME")
    )
    route = lineitem.select(
        F.col("l_orderkey").alias("PORTCALL_ID"), F.col("l_linenumber").alias("TYPE"),
        F.col("l_suppkey").alias("HARBOUR_ID"),
        F.concat(F.lit("Port <"), F.col("l_partkey").cast("string"), F.lit("> & Co")).alias("NAME"),
    )
    harbour = read(spark, folder, "supplier").where("s_acctbal >= 2000").select(
        F.col("s_suppkey").alias("ID"), F.col("s_name").alias("LOCODE")
    )
    sent = orders.where("o_orderstatus = 'O'").select(
        F.when(F.col("o_totalprice") > 250000, "Maripro").otherwise("Maripro Belgium").alias("company"),
        F.concat(F.lit("PC"), F.col("o_orderkey").cast("string")).alias("attribute06"),
    )
    return history, portcall, setup, vessel, route, harbour, sent


_PORTCALL_SQL = f"""
WITH hist AS (SELECT l_orderkey AS pid, CAST(l_shipdate AS DATE) AS cd,
    CASE WHEN l_linestatus = 'F' THEN '08:30:00' ELSE '17:00:00' END AS ct
  FROM lineitem WHERE l_returnflag = 'R' AND CAST(l_shipdate AS DATE) > DATE '{RUN_DATE}' - INTERVAL 7 DAY),
s AS (SELECT r_regionkey + 1 AS id, CASE WHEN r_name = 'AFRICA' THEN 'Other agency'
    WHEN r_name IN ('AMERICA', 'ASIA') THEN 'Maripro BV' ELSE 'Maripro Belgium BV' END AS agent FROM region),
rt AS (SELECT l_orderkey AS pid, l_linenumber AS type, l_suppkey AS hid, 'Port <' || l_partkey || '> & Co' AS name FROM lineitem),
hb AS (SELECT s_suppkey AS id, s_name AS locode FROM supplier WHERE s_acctbal >= 2000),
c AS (
  SELECT agent AS "Agency", 'PC' || o_orderkey AS "PortCallNumber", upper(c_name) AS "VesselName",
    CASE WHEN o_orderstatus <> 'F' THEN upper(o_orderpriority) ELSE '' END AS "VoyageNumber",
    CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 12:00:00' END AS "ETA",
    strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderstatus = 'O' THEN ' 06:15:00' ELSE ' 00:00:00' END AS "ETD",
    rl.name AS "LastPort", hl.locode AS "LastPortLOCODE", rn.name AS "NextPort", hn.locode AS "NextPortLOCODE",
    strftime(cd, '%Y-%m-%d') || ' ' || ct AS "Created",
    CASE agent WHEN 'Maripro BV' THEN 'Maripro' WHEN 'Maripro Belgium BV' THEN 'Maripro Belgium' END AS company
  FROM hist JOIN orders ON o_orderkey = hist.pid
  JOIN s ON s.id = CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
  JOIN customer ON c_custkey = o_custkey
  LEFT JOIN rt rl ON rl.pid = o_orderkey AND rl.type = 1 LEFT JOIN hb hl ON hl.id = rl.hid
  LEFT JOIN rt rn ON rn.pid = o_orderkey AND rn.type = 2 LEFT JOIN hb hn ON hn.id = rn.hid
  WHERE agent IN ('Maripro BV', 'Maripro Belgium BV')),
sent AS (SELECT CASE WHEN o_totalprice > 250000 THEN 'Maripro' ELSE 'Maripro Belgium' END AS company,
    'PC' || o_orderkey AS num FROM orders WHERE o_orderstatus = 'O'),
l AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY company, "PortCallNumber" ORDER BY "Created" DESC,
    "Agency" DESC, "ETA" DESC, "ETD" DESC, "LastPort" DESC, "LastPortLOCODE" DESC, "NextPort" DESC,
    "NextPortLOCODE" DESC, "VesselName" DESC, "VoyageNumber" DESC) = 1),
n AS (SELECT * FROM l c WHERE NOT EXISTS (SELECT 1 FROM sent WHERE sent.company = c.company AND num = "PortCallNumber"))
"""


def _new_portcalls(spark, folder):
    *tables, sent = _portcall_inputs(spark, folder)
    return portcalls.unsent(portcalls.recent_portcalls(*tables, run_date=RUN_DATE), sent)


@query("portcall_feed", _PORTCALL_SQL + "SELECT * FROM n")
def portcall_feed(spark, folder):
    calls = _new_portcalls(spark, folder)
    stamps = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("ETA", "ETD", "Created")}
    return calls.withColumns(stamps)


@query("portcall_listing", _PORTCALL_SQL + """SELECT "PortCallNumber", company, "VesselName" FROM n ORDER BY "PortCallNumber" DESC""")
def portcall_listing(spark, folder):
    """New port calls, highest number first."""
    return portcalls.newest_first(_new_portcalls(spark, folder)).select("PortCallNumber", "company", "VesselName")


_ESCAPED = "replace(replace(coalesce({0}, ''), '&', '&amp;'), '<', '&lt;')"
_DOCUMENT_SQL = (
    f"'<ns0:Message xmlns:ns0=\"{PORTCALL_NAMESPACE}\"><ns0:Header><ns0:MessageID>' || \"PortCallNumber\""
    f" || '</ns0:MessageID><ns0:CreationDateTime>{RUN_DATE}</ns0:CreationDateTime>"
    "<ns0:ProcesAction>INSERT</ns0:ProcesAction><ns0:FromTradingPartner>KMA00038</ns0:FromTradingPartner>"
    "<ns0:ToTradingPartner>' || \"Agency\" || '</ns0:ToTradingPartner></ns0:Header><ns0:Documents><ns0:Document>"
    "<ns0:StatusCode>15-EDI</ns0:StatusCode><ns0:Customer><ns0:No>KMA00038</ns0:No></ns0:Customer>"
    "<ns0:PostingDate>' || substr(\"ETD\", 1, 10) || '</ns0:PostingDate><ns0:ExternalDocumentNo>'"
    " || \"PortCallNumber\" || '</ns0:ExternalDocumentNo><ns0:DeliveryDate>' || substr(\"ETD\", 1, 10)"
    " || '</ns0:DeliveryDate><ns0:EstimatedDepartureDate>' || substr(\"ETD\", 1, 10)"
    " || '</ns0:EstimatedDepartureDate><ns0:OrderTypeCode>AGENCIES</ns0:OrderTypeCode><ns0:PortFrom>' || "
    + _ESCAPED.format('"LastPort"') + " || '</ns0:PortFrom><ns0:PortTo>' || "
    + _ESCAPED.format('"NextPort"') + " || '</ns0:PortTo><ns0:VesselNo>' || \"VesselName\""
    " || '</ns0:VesselNo><ns0:VoyageNo>' || \"VoyageNumber\" || '</ns0:VoyageNo><ns0:Attribute06>'"
    " || \"PortCallNumber\" || '</ns0:Attribute06></ns0:Document></ns0:Documents></ns0:Message>'"
)
_TAIL_SQL = SOAP_TAIL.replace("\n", "' || chr(10) || '")


@query("portcall_messages", _PORTCALL_SQL + f"""
SELECT "PortCallNumber" AS message_id,
  CASE "Agency" WHEN 'Maripro BV' THEN 'Maripro' ELSE 'Maripro%20Belgium' END AS endpoint,
  '{SOAP_HEAD}' || {_DOCUMENT_SQL} || '{_TAIL_SQL}' AS payload
FROM n
""")
def portcall_messages(spark, folder):
    """New port calls as posting messages."""
    documents = portcalls.documents_of(_new_portcalls(spark, folder), RUN_DATE)
    return files.outbox(portcalls.document_messages(documents))
