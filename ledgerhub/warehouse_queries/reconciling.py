"""Reconciliation, completeness and run log."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from ledgerhub.functions.rules import country_group
from ledgerhub.fixed_values import EU_COUNTRIES
from ledgerhub.plans import (
    balance, balance_sums, catalog, count_check, mapping_check, posting_groups, relations, run_log,
)
from ledgerhub.scratch import run_folder, written_once
from ledgerhub.sinks import files, tables
from ledgerhub.sources.counts import counted
from ledgerhub.warehouse_queries.base import (
    DOCUMENTS_SQL, ENTRIES_SQL, companies, customer_companies, documents, entries, moment, money,
    plain, query, read, registry, supplier_companies,
)


def _balance_inputs(spark, folder):
    """Source knows everything but headings; staging lags behind; the datamart lacks more."""
    booked = entries(spark, folder)
    part = read(spark, folder, "part").where("p_size <= 40").select("p_partkey")
    accounts = booked.where("l_linestatus = 'F'").join(
        part, F.col("l_partkey") == F.col("p_partkey"), "left_semi"
    ).select(F.col("l_partkey").alias("no"), "Entity")
    api = booked.select(
        F.col("l_partkey").alias("no"), "Entity", money("l_extendedprice").alias("balance"),
        F.when(F.col("l_returnflag") == "R", "Heading").otherwise("Posting").alias("apiAccountType"),
    )
    loaded = booked.where(
        (F.col("l_returnflag") != "R") & (F.col("l_shipdate") < moment("2001-01-01"))
    )
    gl_entries = loaded.select(
        F.col("l_partkey").alias("gLAccountNo"), "Entity", money("l_extendedprice").alias("amount")
    )
    supplier = read(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    lineitem = read(spark, folder, "lineitem").where(
        (F.col("l_returnflag") != "R") & (F.col("l_shipdate") < moment("2001-01-01"))
        & (F.col("l_discount") < 0.1)
    )
    fact = lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat_ws("|", "l_partkey", "l_returnflag").alias("DK_DimGrootboek"),
        F.col("s_nationkey").alias("DK_DimCompany"), money("l_extendedprice").alias("bedrag"),
    )
    dim = read(spark, folder, "nation").select(
        F.col("n_nationkey").alias("Company"), F.col("n_name").alias("Naam database")
    )
    return accounts, api, gl_entries, fact, dim


def _balance(spark, folder):
    accounts, api, gl_entries, fact, dim = _balance_inputs(spark, folder)
    checked = balance.balance_check(
        accounts,
        balance.source_amounts(api),
        balance.staging_amounts(gl_entries),
        balance.datamart_amounts(balance.datamart_rows(fact, dim)),
    )
    return checked


def _plain_balance(checked):
    sums = ["API_Amount", "Staging_Amount", "Datamart_Amount", "Deviation"]
    return checked.select("GL_Account", "Entity", *[plain(c).alias(c) for c in sums])


_BALANCE_SQL = f"""
WITH {ENTRIES_SQL},
x AS (SELECT CAST(l_partkey AS VARCHAR) AS account, "Entity",
        CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_returnflag AS flag,
        l_linestatus AS state, l_shipdate AS shipped, l_discount AS discount, l_partkey FROM e),
accts AS (SELECT DISTINCT account, "Entity" FROM x JOIN part ON l_partkey = p_partkey
          WHERE state = 'F' AND p_size <= 40),
api AS (SELECT account, "Entity", sum(amount) AS v FROM x WHERE flag <> 'R' GROUP BY account, "Entity"),
stg AS (SELECT account, "Entity", sum(amount) AS v FROM x
        WHERE flag <> 'R' AND shipped < '2001-01-01' GROUP BY account, "Entity"),
dm AS (SELECT account, "Entity", sum(amount) AS v FROM x
       WHERE flag <> 'R' AND shipped < '2001-01-01' AND discount < 0.1 GROUP BY account, "Entity"),
c AS (SELECT a.account, a."Entity", coalesce(api.v, 0) AS s, coalesce(stg.v, 0) AS t,
             coalesce(dm.v, 0) AS m
      FROM accts a
      LEFT JOIN api ON api.account = a.account AND api."Entity" = a."Entity"
      LEFT JOIN stg ON stg.account = a.account AND stg."Entity" = a."Entity"
      LEFT JOIN dm ON dm.account = a.account AND dm."Entity" = a."Entity")
SELECT account AS "GL_Account", "Entity", CAST(s AS DOUBLE) AS "API_Amount",
       CAST(t AS DOUBLE) AS "Staging_Amount", CAST(m AS DOUBLE) AS "Datamart_Amount",
       CAST(abs(s - t) + abs(t - m) AS DOUBLE) AS "Deviation"
FROM c
"""


@query("balance_recon", _BALANCE_SQL + "WHERE abs(s - t) + abs(t - m) <> 0")
def balance_recon(spark, folder):
    """Accounts whose sums differ between source, staging and datamart."""
    return _plain_balance(balance.deviations(_balance(spark, folder)))


@query("balance_incremental", _BALANCE_SQL + "WHERE abs(s - t) + abs(t - m) <> 0")
def balance_incremental(spark, folder):
    """``balance_recon`` with staging sums kept by three loads: old entries, some with another account or
    amount than in the end, later ones with corrections of these, and the last corrections."""
    accounts, api, _, fact, dim = _balance_inputs(spark, folder)
    key = ["l_orderkey", "l_linenumber", "l_suppkey"]  # not unique in these tables
    place = F.row_number().over(Window.partitionBy(*key).orderBy("l_partkey", "l_extendedprice", "l_shipdate"))
    rows = written_once(entries(spark, folder).where(
        (F.col("l_returnflag") != "R") & (F.col("l_shipdate") < moment("2001-01-01"))
    ).select(
        F.concat_ws("-", *key, place).alias("id"), F.col("l_partkey").alias("gLAccountNo"),
        money("l_extendedprice").alias("amount"), F.col("l_linenumber").alias("line"), F.col("l_shipdate").alias("shipped"), "Entity",
    ), "entries")
    shape = ["id", "gLAccountNo", "amount", "Entity"]
    wrong = rows.withColumns({
        "amount": F.when(F.col("line") == 2, F.lit(0)).otherwise(F.col("amount")).cast("decimal(18,2)"),
        "gLAccountNo": F.when(F.col("line") == 3, F.col("gLAccountNo") + 1).otherwise(F.col("gLAccountNo")),
    })
    old = F.col("shipped") < moment("1998-01-01")
    loads = [
        wrong.where(old).select(*shape),
        rows.where(~old | (F.col("line") == 2)).select(*shape),
        rows.where(old & (F.col("line") == 3)).select(*shape),
    ]
    entry = catalog.Dataset("gl", "entries", catalog.MERGE, keys=("id", "Entity"))
    name = f"gl_{uuid.uuid4().hex}"
    tables.create(spark, name, rows.select(*shape).schema, run_folder(spark, "table"))
    sums = balance_sums.Sums(run_folder(spark, "sums"), "gLAccountNo", "amount")
    for i, batch in enumerate(loads):
        balance_sums.run(entry, batch, name, "2001-01-01", sums, f"load{i}")
    checked = balance.balance_check(
        accounts, balance.source_amounts(api), balance_sums.staging_amounts(spark, sums),
        balance.datamart_amounts(balance.datamart_rows(fact, dim)),
    )
    return _plain_balance(balance.deviations(checked))


@query("check_mutations", _BALANCE_SQL)
def check_mutations(spark, folder):
    """The stored comparison holds every account, equal ones too."""
    store = run_folder(spark, "mutations")
    _balance(spark, folder).write.mode("overwrite").parquet(store)
    return _plain_balance(spark.read.parquet(store))


@query("datamart_rejects", f"""
WITH {ENTRIES_SQL},
x AS (SELECT l_returnflag = 'N' AS no_prefix, region = 'AFRICA' AS no_company,
             CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM e)
SELECT CASE WHEN no_prefix THEN 'no account prefix' ELSE 'no company' END AS reason,
       count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS amount
FROM x WHERE no_prefix OR no_company GROUP BY 1
""")
def datamart_rejects(spark, folder):
    """Keys without a separator and companies the dimension does not know."""
    fact = entries(spark, folder).select(
        F.when(F.col("l_returnflag") == "N", F.col("l_partkey").cast("string")).otherwise(
            F.concat_ws("|", "l_partkey", "l_returnflag")
        ).alias("DK_DimGrootboek"),
        F.col("s_nationkey").alias("DK_DimCompany"), money("l_extendedprice").alias("bedrag"),
    )
    dim = companies(spark, folder).where("region <> 'AFRICA'").select(
        F.col("n_nationkey").alias("Company"), F.col("Entity").alias("Naam database")
    )
    rejected = balance.datamart_rejects(balance.datamart_rows(fact, dim))
    return rejected.withColumn("amount", plain("amount"))


def _count_inputs(spark, folder):
    """Every order counts at the source; only orders with an entry have reached the table."""
    source = documents(spark, folder)
    answer = F.when(F.col("region") == "ASIA", "error").otherwise(
        F.concat(F.lit("﻿ "), F.count(F.lit(1)).cast("string"), F.lit(" "))
    )
    answers = source.groupBy("Entity", "region").agg(answer.alias("answer"))
    counts = answers.select("Entity", counted(F.col("answer")).alias("source_rows"))
    entry = read(spark, folder, "lineitem").where("l_linestatus = 'F'")
    table = source.join(
        entry.select(F.col("l_orderkey").alias("entryNo")).distinct(), "entryNo", "left_semi"
    )
    return registry(spark, folder), counts, table


_COUNT_SQL = f"""
WITH {DOCUMENTS_SQL},
s AS (SELECT "Entity", CASE WHEN region <> 'ASIA' THEN count(*) END AS source_rows, 1 AS known
      FROM o GROUP BY "Entity", region),
t AS (SELECT "Entity", count(*) AS table_rows FROM o
      WHERE "entryNo" IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') GROUP BY "Entity"),
j AS (SELECT n_name AS "Entity", CASE WHEN known = 1 THEN source_rows ELSE 0 END AS source_rows,
             coalesce(table_rows, 0) AS table_rows
      FROM nation LEFT JOIN s ON s."Entity" = n_name LEFT JOIN t ON t."Entity" = n_name),
c AS (SELECT *, abs(source_rows - table_rows) AS difference,
        CASE WHEN source_rows IS NULL THEN 'unknown' WHEN source_rows = table_rows THEN 'equal'
             ELSE 'mismatch' END AS status FROM j)
"""


@query("count_recon", _COUNT_SQL + """
SELECT "Entity", source_rows, table_rows, difference,
       'Mismatch in row count for ' || "Entity" || ': API rows ' || source_rows
         || ', SQL rows ' || table_rows AS error_details
FROM c WHERE status = 'mismatch'
""")
def count_recon(spark, folder):
    return count_check.mismatches(count_check.count_check(*_count_inputs(spark, folder)))


@query("count_totals", _COUNT_SQL + """
SELECT status, count(*) AS companies, CAST(coalesce(sum(difference), 0) AS BIGINT) AS rows_apart
FROM c GROUP BY status
""")
def count_totals(spark, folder):
    return count_check.check_totals(count_check.count_check(*_count_inputs(spark, folder)))


def _missing(spark, folder):
    """Mapped are the accounts of ordinary size; two companies do not count."""
    accounts = entries(spark, folder).select(
        F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("no"), "Entity"
    )
    mapping = read(spark, folder, "part").where("p_size <= 30").select(
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("Ledgernummer")
    )
    return mapping_check.missing_accounts(
        accounts, mapping, "Ledgernummer", ["NATION_3 ", "NATION_7"]
    )


_MISSING_SQL = f"""
WITH {ENTRIES_SQL},
m AS (SELECT DISTINCT lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS no FROM e
      WHERE "Entity" NOT IN ('NATION_3', 'NATION_7')
        AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 30))
"""


@query("missing_mapping", _MISSING_SQL + "SELECT no FROM m")
def missing_mapping(spark, folder):
    return _missing(spark, folder)


@query("missing_message", _MISSING_SQL + """
SELECT no, CAST(NULL AS BIGINT) AS total_missing, 'Value missing in Excel: ' || no AS error_details FROM m
UNION ALL
SELECT NULL, count(*), 'Values missing in Excel: ' || count(*) FROM m HAVING count(*) > 0
""")
def missing_message(spark, folder):
    return mapping_check.missing_message(_missing(spark, folder))


def _relations(spark, folder):
    codes = F.array(*[F.lit(code) for code in EU_COUNTRIES])
    code = (
        F.when(F.col("region") == "AMERICA", "US")
        .when(F.col("region") == "AFRICA", "")
        .otherwise(F.element_at(codes, F.col("n_nationkey") + 1))
    )
    coded = companies(spark, folder).withColumn("code", code)
    countries = coded.select(
        F.lit("all").alias("company"), "code", F.when(F.col("code") != "", F.col("Entity")).alias("displayName")
    )
    coded = coded.select("n_nationkey", "code")
    group = (
        F.when(F.col("c_mktsegment") == "BUILDING", "BINNENLAND")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "EU")
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit(None))
        .otherwise("EXPORT")
    )
    customers = read(spark, folder, "customer").join(
        coded, F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.lit("all").alias("company"), F.col("c_custkey").cast("string").alias("no"),
        F.col("c_name").alias("name"), F.col("code").alias("countryRegionCode"),
        group.alias("customerPostingGroup"), country_group(F.col("code")).alias("genBusPostingGroup"),
        F.when(F.col("c_acctbal") < 0, "EU").otherwise("EXPORT").alias("vatBusPostingGroup"),
    )
    vendors = read(spark, folder, "supplier").join(
        coded, F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.lit("all").alias("company"), F.col("s_suppkey").cast("string").alias("no"),
        F.col("s_name").alias("name"), F.col("code").alias("countryRegionCode"),
        F.lit("EU").alias("vendorPostingGroup"), country_group(F.col("code")).alias("genBusPostingGroup"),
        F.when(F.col("s_acctbal") < 5000, "EU").otherwise("EXPORT").alias("vatBusPostingGroup"),
    )
    return customers, vendors, countries


_EU_SQL = ", ".join(f"'{code}'" for code in EU_COUNTRIES)
_POSTING_SQL = f"""
WITH n AS (
  SELECT n_nationkey, n_name, CASE r_name WHEN 'AMERICA' THEN 'US' WHEN 'AFRICA' THEN ''
         ELSE ([{_EU_SQL}])[n_nationkey + 1] END AS code
  FROM nation JOIN region ON n_regionkey = r_regionkey),
g AS (SELECT *, CASE WHEN code = 'NL' THEN 'BINNENLAND' WHEN code IN ({_EU_SQL}) THEN 'EU'
                ELSE 'EXPORT' END AS class FROM n),
p AS (
  SELECT 'Customer' AS "Src", CAST(c_custkey AS VARCHAR) AS "Entity", c_name AS "Name", code AS "Country",
    n_name, class, 'customerPostingGroup' AS own,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'BINNENLAND' WHEN 'AUTOMOBILE' THEN 'EU'
      WHEN 'MACHINERY' THEN NULL ELSE 'EXPORT' END AS g1,
    CASE WHEN c_acctbal < 0 THEN 'EU' ELSE 'EXPORT' END AS g3
  FROM customer JOIN g ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 'Vendor', CAST(s_suppkey AS VARCHAR), s_name, code, n_name, class, 'vendorPostingGroup', 'EU',
    CASE WHEN s_acctbal < 5000 THEN 'EU' ELSE 'EXPORT' END
  FROM supplier JOIN g ON s_nationkey = n_nationkey),
q AS (SELECT *, CASE WHEN "Country" <> '' THEN class ELSE 'Unknown' END AS correct FROM p),
l AS (
  SELECT "Src", 'all' AS company, "Entity", "Name", "Country", own AS group_name, g1 AS actual, correct FROM q
  UNION ALL SELECT "Src", 'all', "Entity", "Name", "Country", 'genBusPostingGroup', class, correct FROM q
  UNION ALL SELECT "Src", 'all', "Entity", "Name", "Country", 'vatBusPostingGroup', g3, correct FROM q),
w AS (SELECT * FROM l WHERE actual IS DISTINCT FROM correct)
"""


@query("posting_group_check", _POSTING_SQL + """
SELECT "Src", company, "Entity", "Name", "Country",
  CASE WHEN group_name = 'customerPostingGroup' THEN actual END AS "customerPostingGroup",
  CASE WHEN group_name = 'customerPostingGroup' THEN correct END AS "CorrectCustomerpostinggroup",
  CASE WHEN group_name = 'genBusPostingGroup' THEN actual END AS "genBusPostingGroup",
  CASE WHEN group_name = 'genBusPostingGroup' THEN correct END AS "CorrectGenbuspostinggroup",
  CASE WHEN group_name = 'vatBusPostingGroup' THEN actual END AS "vatBusPostingGroup",
  CASE WHEN group_name = 'vatBusPostingGroup' THEN correct END AS "CorrectVatbuspostinggroup",
  CASE WHEN group_name = 'vendorPostingGroup' THEN actual END AS "vendorPostingGroup",
  CASE WHEN group_name = 'vendorPostingGroup' THEN correct END AS "CorrectVendorpostinggroup"
FROM w
""")
def posting_group_check(spark, folder):
    return posting_groups.wide_report(
        posting_groups.posting_group_mismatches(*_relations(spark, folder))
    )


@query("posting_group_long", _POSTING_SQL + "SELECT * FROM w")
def posting_group_long(spark, folder):
    return posting_groups.posting_group_mismatches(*_relations(spark, folder))


_COUNTRY_GUARD_SQL = """
SELECT n_name AS name, r_name <> 'AFRICA' AS usable FROM nation JOIN region ON n_regionkey = r_regionkey
"""


@query("country_guard", _COUNTRY_GUARD_SQL)
def country_guard(spark, folder):
    """Country records without code or name are set aside, not lost."""
    coded = companies(spark, folder).select(
        F.when(F.col("region") != "AFRICA", F.col("n_nationkey")).alias("code"),
        F.col("Entity").alias("displayName"),
    )
    usable, rejects = posting_groups.usable_countries(coded)
    return usable.select(F.col("displayName").alias("name"), F.lit(True).alias("usable")).unionByName(
        rejects.select(F.col("displayName").alias("name"), F.lit(False).alias("usable"))
    )


@query("relation_growth", """
WITH f AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS created FROM orders GROUP BY o_custkey),
c AS (SELECT c_nationkey AS k, created FROM customer LEFT JOIN f ON c_custkey = o_custkey),
s AS (SELECT s_suppkey, s_nationkey AS k, CAST(min(l_shipdate) AS DATE) AS created
      FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey, s_nationkey)
SELECT '1995-01-02' AS date, n_name AS "Entity",
  (SELECT count(*) FROM c WHERE k = n_nationkey AND created = DATE '1995-01-02') AS new_customers,
  (SELECT count(*) FROM c WHERE k = n_nationkey) AS ttl_customers,
  (SELECT count(*) FROM s WHERE k = n_nationkey AND created = DATE '1995-01-02') AS "new_Vendors",
  (SELECT count(*) FROM s WHERE k = n_nationkey) AS ttl_vendors
FROM nation
""")
def relation_growth(spark, folder):
    """A customer is created with the first order, a vendor with the first delivery."""
    first_order = read(spark, folder, "orders").groupBy(
        F.col("o_custkey").alias("c_custkey")
    ).agg(F.min("o_orderdate").alias("systemCreatedAt"))
    customers = customer_companies(spark, folder).join(first_order, "c_custkey", "left")
    first_delivery = read(spark, folder, "lineitem").groupBy(
        F.col("l_suppkey").alias("s_suppkey")
    ).agg(F.min("l_shipdate").alias("systemCreatedAt"))
    vendors = supplier_companies(spark, folder).join(first_delivery, "s_suppkey", "left")
    store = run_folder(spark, "relations")
    grown = relations.relation_growth(registry(spark, folder), customers, vendors, "1995-01-02")
    files.append_rows(grown, store)
    return spark.read.parquet(store).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("load_self_check", f"""
WITH {DOCUMENTS_SQL},
c AS (SELECT "Entity", count(*) AS pulled, count(*) FILTER (WHERE status <> 'P' OR region <> 'ASIA') AS inserted
      FROM o GROUP BY "Entity")
SELECT *, CASE WHEN pulled = inserted THEN 'Success' ELSE 'Error' END AS status FROM c
""")
def load_self_check(spark, folder):
    """A load that loses rows is found by reading back what was stored."""
    batch = documents(spark, folder)
    store = run_folder(spark, "selfcheck")
    kept = batch.where("status <> 'P' or region <> 'ASIA'")
    kept.select("entryNo", "Entity").write.parquet(store)
    return run_log.load_check(batch, spark.read.parquet(store))


def _event_log(spark, folder):
    runs = read(spark, folder, "events").select(
        F.concat(F.lit("company "), F.col("user_id").cast("string")).alias("company"),
        (F.col("event_type") != "error").alias("ok"),
        F.col("ts").cast("timestamp").alias("started"),
        (F.col("ts").cast("timestamp") + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)") * 10)).alias("ended"),
        F.floor("value").alias("records"), F.lit("").alias("details"), F.lit("N/A").alias("uri"),
    )
    return run_log.log_rows(runs, "DWH_extract", "events")


_LOG_SQL = """
WITH r AS (SELECT 'company ' || user_id AS company_name, event_type <> 'error' AS ok,
             CAST(floor(value) AS BIGINT) AS records,
             CAST(floor(CAST(value AS DECIMAL(18,6)) * 10 / 60) AS INTEGER) AS minutes FROM events),
s AS (SELECT company_name, count(*) FILTER (WHERE ok) AS successes, count(*) FILTER (WHERE NOT ok) AS failures,
        CAST(coalesce(sum(records) FILTER (WHERE ok), 0) AS BIGINT) AS rows_inserted,
        CAST(sum(minutes) AS BIGINT) AS minutes FROM r GROUP BY company_name)
"""


@query("run_summary", _LOG_SQL + "SELECT * FROM s")
def run_summary(spark, folder):
    """Events as runs of one job per company, through a stored run log."""
    store = run_folder(spark, "runlog")
    files.append_rows(_event_log(spark, folder), store)
    return run_log.run_summary(spark.read.parquet(store))


@query("run_totals", _LOG_SQL + """
SELECT count(*) FILTER (WHERE failures > 0) AS companies_in_error,
       CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted FROM s
""")
def run_totals(spark, folder):
    return run_log.run_totals(run_log.run_summary(_event_log(spark, folder)))


@query("relation_union", """
SELECT c_custkey AS no, c_name AS name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) FROM supplier
""")
def relation_union(spark, folder):
    """Two result lists with different columns as one."""
    customers = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("no"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    vendors = read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("no"), F.col("s_name").alias("name"),
        money("s_acctbal").cast("string").alias("balance"),
    )
    return posting_groups.all_relations(customers, vendors)
