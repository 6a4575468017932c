"""Three-way balance reconciliation: source, staging, datamart."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerhub.functions.money import AMOUNT, gap
from ledgerhub.functions.text import key_prefix
from ledgerhub.operators.alignment import aligned_amounts
from ledgerhub.sizing import company_side

POSTING = "Posting"


def source_amounts(api_accounts: DataFrame) -> DataFrame:
    """Balances the source reports for its posting accounts."""
    posting = api_accounts.where(F.col("apiAccountType") == POSTING)
    return posting.select(
        F.col("no").cast("string").alias("account"), "Entity", F.col("balance").alias("amount")
    )


def staging_amounts(gl_entries: DataFrame) -> DataFrame:
    return gl_entries.select(
        F.col("gLAccountNo").cast("string").alias("account"), "Entity", "amount"
    )


def datamart_rows(fact: DataFrame, companies: DataFrame) -> DataFrame:
    """Fact rows with account and company name; either is NULL where it cannot be told."""
    dim = companies.select(
        F.col("Company").alias("DK_DimCompany"), F.col("Naam database").alias("Entity")
    )
    return fact.join(company_side(dim), "DK_DimCompany", "left").select(
        key_prefix(F.col("DK_DimGrootboek")).alias("account"), "Entity",
        F.col("bedrag").alias("amount"),
    )


def datamart_amounts(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("account").isNotNull() & F.col("Entity").isNotNull())


def datamart_rejects(rows: DataFrame) -> DataFrame:
    """Fact rows that cannot take part, counted by reason."""
    reason = F.when(F.col("account").isNull(), "no account prefix").otherwise("no company")
    rejected = rows.where(F.col("account").isNull() | F.col("Entity").isNull())
    return rejected.groupBy(reason.alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("amount").cast(AMOUNT)).alias("amount")
    )


def balance_check(
    accounts: DataFrame, source: DataFrame, staging: DataFrame, datamart: DataFrame
) -> DataFrame:
    """One row per (account, company) of the account table, with the deviation.

    ``accounts`` holds ``no`` and ``Entity``; the others come from the functions above.
    """
    driving = accounts.select(F.col("no").cast("string").alias("account"), "Entity")
    sums = aligned_amounts(
        driving,
        {"API_Amount": source, "Staging_Amount": staging, "Datamart_Amount": datamart},
    )
    deviation = gap(F.col("API_Amount"), F.col("Staging_Amount")) + gap(
        F.col("Staging_Amount"), F.col("Datamart_Amount")
    )
    return sums.select(
        F.col("account").alias("GL_Account"),
        "Entity",
        "API_Amount",
        "Staging_Amount",
        "Datamart_Amount",
        deviation.cast(AMOUNT).alias("Deviation"),
    )


def deviations(check_mutations: DataFrame) -> DataFrame:
    return check_mutations.where(F.col("Deviation") != 0)
