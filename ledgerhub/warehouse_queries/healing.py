"""Holes, differing rows and their repair, on copies of the given tables with faults put in."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerhub.plans import count_check, digest_check
from ledgerhub.warehouse_queries.base import DOCUMENTS_SQL, documents, query, read


@query("entry_gaps", f"""
WITH {DOCUMENTS_SQL},
n AS (SELECT "Entity", "entryNo", lead("entryNo") OVER (PARTITION BY "Entity" ORDER BY "entryNo") AS nxt
      FROM (SELECT DISTINCT "Entity", "entryNo" FROM o))
SELECT "Entity", "entryNo" + 1 AS first_no, nxt - 1 AS last_no, nxt - "entryNo" - 1 AS missing
FROM n WHERE nxt > "entryNo" + 1
""")
def entry_gaps(spark, folder):
    """The numbers that each company's documents skip."""
    return count_check.entry_gaps(documents(spark, folder), "entryNo")


_HOLES_SQL = f"""
WITH {DOCUMENTS_SQL},
t AS (SELECT * FROM o WHERE NOT (region = 'EUROPE' AND status = 'P') AND "entryNo" % 7 <> 0
        AND NOT (region = 'ASIA' AND order_date >= '2001-01-01')),
h AS (SELECT "entryNo", "Entity", total FROM o
      WHERE NOT EXISTS (SELECT 1 FROM t WHERE t."Entity" = o."Entity" AND t."entryNo" = o."entryNo"))
"""


def _with_holes(spark, folder):
    """Source, and a table without single numbers, some kinds and the latest of some companies, but with strangers."""
    source = documents(spark, folder)
    lost = ((F.col("region") == "EUROPE") & (F.col("status") == "P")) | (F.col("entryNo") % 7 == 0) | (
        (F.col("region") == "ASIA") & (F.col("order_date") >= "2001-01-01"))
    shape = ["entryNo", "Entity", "total"]
    table = source.where(~lost).select(*shape)
    strangers = table.where("entryNo % 11 = 0").withColumn("entryNo", F.col("entryNo") + 10_000_000_000)
    return source.select(*shape), table.unionByName(strangers)


@query("repair_holes", _HOLES_SQL + 'SELECT * FROM h')
def repair_holes(spark, folder):
    """The rows to append: those of the missing ranges, wherever they lie."""
    source, table = _with_holes(spark, folder)
    return count_check.hole_rows(source, table, "entryNo")


@query("missing_ranges", _HOLES_SQL + """,
s AS (SELECT "Entity", "entryNo", row_number() OVER (PARTITION BY "Entity" ORDER BY "entryNo") AS r FROM h)
SELECT "Entity", min("entryNo") AS first_no, max("entryNo") AS last_no, count(*) AS missing
FROM s GROUP BY "Entity", "entryNo" - r
""")
def missing_ranges(spark, folder):
    source, table = _with_holes(spark, folder)
    return count_check.missing_ranges(source, table, "entryNo")


_DIGEST_SQL = f"""
WITH {DOCUMENTS_SQL},
s AS (SELECT "entryNo", "Entity", total, status, priority FROM o),
t AS (SELECT "entryNo", "Entity", CASE WHEN "entryNo" % 997 = 1 THEN total + 0.01 ELSE total END AS total,
             CASE WHEN "entryNo" % 991 = 2 THEN NULL ELSE status END AS status, priority
      FROM o WHERE "entryNo" % 983 <> 3
      UNION ALL SELECT "entryNo", "Entity", total, status, priority FROM o WHERE "entryNo" % 977 = 4
      UNION ALL SELECT "entryNo" + 50000000, "Entity", total, status, priority FROM o WHERE "entryNo" % 971 = 5),
a AS (SELECT "Entity", "entryNo", count(*) AS n, list(struct_pack(total, status, priority) ORDER BY total, status, priority) AS v FROM s GROUP BY ALL),
b AS (SELECT "Entity", "entryNo", count(*) AS n, list(struct_pack(total, status, priority) ORDER BY total, status, priority) AS v FROM t GROUP BY ALL)
SELECT coalesce(a."Entity", b."Entity") AS "Entity", coalesce(a."entryNo", b."entryNo") AS "entryNo",
       coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows,
       CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'extra' WHEN a.n <> b.n THEN 'repeated' ELSE 'changed' END AS status
FROM a FULL JOIN b ON a."Entity" = b."Entity" AND a."entryNo" = b."entryNo"
WHERE a.v IS DISTINCT FROM b.v
"""


def faulty_copy(source):
    """A copy with changed amounts, lost texts, lost rows, repeated rows and strangers, a few of each."""
    number = F.col("entryNo")
    base = source.where(number % 983 != 3).withColumns({
        "total": F.when(number % 997 == 1, F.col("total") + 0.01).otherwise(F.col("total")),
        "status": F.when(number % 991 != 2, F.col("status")),
    })
    strangers = source.where(number % 971 == 5).withColumn("entryNo", number + 50_000_000)
    return base.unionByName(source.where(number % 977 == 4)).unionByName(strangers)


@query("digest_recon", _DIGEST_SQL)
def digest_recon(spark, folder):
    """Rows that differ between source and table, through ranges of entry numbers."""
    source = documents(spark, folder).select("entryNo", "Entity", "total", "status", "priority")
    return digest_check.digest_check(source, faulty_copy(source), ["entryNo"], number="entryNo")


@query("digest_reload", f"""
WITH {DOCUMENTS_SQL}
SELECT "entryNo", "Entity", total, status, priority FROM o
WHERE "entryNo" % 997 = 1 OR "entryNo" % 991 = 2 OR "entryNo" % 983 = 3 OR "entryNo" % 977 = 4
""")
def digest_reload(spark, folder):
    """The rows that a repair loads again; ranges are those of a hash of the key here."""
    source = documents(spark, folder).select("entryNo", "Entity", "total", "status", "priority")
    found = digest_check.digest_check(source, faulty_copy(source), ["entryNo"])
    return digest_check.differing_rows(source, found, ["entryNo"])
