"""Posting groups of customers and vendors against their country's class."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerhub.fixed_values import UNKNOWN_GROUP
from ledgerhub.functions.rules import country_group
from ledgerhub.operators.binding import split_required
from ledgerhub.operators.load import fan_out
from ledgerhub.sizing import broadcast_within

CUSTOMER_GROUPS = ["customerPostingGroup", "genBusPostingGroup", "vatBusPostingGroup"]
VENDOR_GROUPS = ["vendorPostingGroup", "genBusPostingGroup", "vatBusPostingGroup"]


def usable_countries(countries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Country records with code and name, and the others for the log."""
    return split_required(countries, ["code", "displayName"])


def _mismatches(
    relations: DataFrame, groups: list[str], source: str, expected: DataFrame
) -> DataFrame:
    keyed = relations.withColumn("code", F.col("countryRegionCode"))
    looked_up = keyed.join(expected, ["company", "code"], "left").withColumn(
        "correct", F.coalesce("correct", F.lit(UNKNOWN_GROUP))
    )
    long = looked_up.select(
        F.lit(source).alias("Src"),
        "company",
        F.col("no").alias("Entity"),
        F.col("name").alias("Name"),
        F.col("countryRegionCode").alias("Country"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(g).alias("group_name"), F.col(g).alias("actual"))
                    for g in groups
                ]
            )
        ).alias("g"),
        "correct",
    ).select("Src", "company", "Entity", "Name", "Country", "g.*", "correct")
    return long.where(~F.col("actual").eqNullSafe(F.col("correct")))


def posting_group_mismatches(
    customers: DataFrame, vendors: DataFrame, countries: DataFrame
) -> DataFrame:
    """One row per wrong group; all frames carry their company in ``company``.

    A blank or unregistered country expects ``Unknown``, so all three groups are wrong.
    """
    usable, _ = usable_countries(countries)
    expected = broadcast_within(
        usable.select("company", "code").distinct().withColumn(
            "correct", country_group(F.col("code"))
        )
    )
    return _mismatches(customers, CUSTOMER_GROUPS, "Customer", expected).unionByName(
        _mismatches(vendors, VENDOR_GROUPS, "Vendor", expected)
    )


def report_column(group: str) -> str:
    """Column of the expected value in the wide report."""
    return f"Correct{group.capitalize()}"


def wide_report(mismatched: DataFrame) -> DataFrame:
    """One row per wrong group with a pair of columns per group, absent pairs NULL."""
    pairs = []
    for group in CUSTOMER_GROUPS + VENDOR_GROUPS[:1]:
        here = F.col("group_name") == group
        pairs.append(F.when(here, F.col("actual")).alias(group))
        pairs.append(F.when(here, F.col("correct")).alias(report_column(group)))
    return mismatched.select("Src", "company", "Entity", "Name", "Country", *pairs)


def all_relations(customers: DataFrame, vendors: DataFrame) -> DataFrame:
    """Customers and vendors in one frame, columns of the other kind NULL."""
    return fan_out([customers, vendors])
