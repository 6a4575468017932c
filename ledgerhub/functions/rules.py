"""Rule tables as column expressions: no join, so no shuffle and nothing to broadcast."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from ledgerhub import fixed_values as fv


def first_fragment(
    text: Column, rules: Iterable[tuple[str, str]], longest_first: bool = False
) -> Column:
    """Value of the first rule whose fragment occurs in the text, else NULL.

    ``longest_first`` lets a longer fragment win over a shorter one inside it.
    """
    ordered = list(rules)
    if longest_first:
        ordered.sort(key=lambda rule: -len(rule[0]))
    result = F.lit(None).cast("string")
    for fragment, value in reversed(ordered):
        result = F.when(F.contains(text, F.lit(fragment)), F.lit(value)).otherwise(result)
    return result


def lookup(key: Column, table: Mapping[str, object]) -> Column:
    """Value for the key, else NULL."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def payment_company(transaction: Column, longest_first: bool = False) -> Column:
    return first_fragment(transaction, fv.TRANSACTION_COMPANIES, longest_first)


def payment_company_code(transaction: Column, longest_first: bool = False) -> Column:
    return first_fragment(transaction, fv.TRANSACTION_COMPANY_CODES, longest_first)


def invoice_kind(invoice_no: Column) -> Column:
    return F.when(F.startswith(invoice_no, F.lit(fv.SALES_PREFIX)), fv.SALES_KIND).otherwise(
        fv.PURCHASE_KIND
    )


def currency_ledger(currency: Column) -> Column:
    return lookup(currency, fv.CURRENCY_LEDGERS)


def agency_company(agency: Column) -> Column:
    return lookup(agency, {name: pair[0] for name, pair in fv.AGENCY_COMPANIES.items()})


def agency_path(agency: Column) -> Column:
    return lookup(agency, {name: pair[1] for name, pair in fv.AGENCY_COMPANIES.items()})


def country_group(code: Column) -> Column:
    """Posting group a relation in this country must have."""
    return (
        F.when(code == fv.DOMESTIC_COUNTRY, fv.DOMESTIC_GROUP)
        .when(code.isin(fv.EU_COUNTRIES), fv.EU_GROUP)
        .otherwise(fv.EXPORT_GROUP)
    )
