"""Growth of customers and vendors per company and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerhub.operators.changes import created_on


def relation_growth(
    names: DataFrame,
    customers: DataFrame,
    vendors: DataFrame,
    run_date: str,
    created: str = "systemCreatedAt",
    entity: str = "Entity",
) -> DataFrame:
    """New and all customers and vendors of every registered company.

    Both tables and the registry meet in one aggregate over the company.
    """
    def part(df: DataFrame, kind: str) -> DataFrame:
        return df.select(
            F.col(entity).alias("Entity"), F.lit(kind).alias("kind"),
            created_on(F.col(created), run_date).alias("is_new"),
        )

    registered = names.select(
        F.col("name").alias("Entity"), F.lit("company").alias("kind"),
        F.lit(False).alias("is_new"),
    )
    rows = registered.unionByName(part(customers, "customer")).unionByName(
        part(vendors, "vendor")
    )

    def total(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    def new(kind: str) -> Column:
        return F.count_if((F.col("kind") == kind) & F.col("is_new"))

    grown = rows.groupBy("Entity").agg(
        new("customer").alias("new_customers"),
        total("customer").alias("ttl_customers"),
        new("vendor").alias("new_Vendors"),
        total("vendor").alias("ttl_vendors"),
        total("company").alias("_registered"),
    )
    return grown.where("_registered > 0").select(
        F.lit(run_date).cast("date").alias("date"),
        "Entity", "new_customers", "ttl_customers", "new_Vendors", "ttl_vendors",
    )
