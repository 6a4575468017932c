"""Open invoices matched with settled ERP invoices, as payment messages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerhub.fixed_values import PAY_MODE
from ledgerhub.functions import money, rules
from ledgerhub.functions.text import last_token
from ledgerhub.functions.xml import element
from ledgerhub.operators.latest import first_per_key
from ledgerhub.operators.presence import present, sieved
from ledgerhub.scratch import written_once
from ledgerhub.sizing import fits_broadcast

LEAD_LENGTH = 2
MAX_SHAPES = 5000
MAX_WANTED = 4_000_000
# The number first: grouping sorts by the first bytes of the first key.
MATCH_KEYS = ["invoice_no", "company", "kind"]

PAYMENT_FIELDS = [
    "invoiceTransNo", "entryDate", "actDate", "externalRefId", "payMode", "currencyAmount",
    "currency", "baseCurrencyAmount", "bankXCRate", "bankCode", "companyCode",
]


def routed(open_invoices: DataFrame, longest_first: bool = False) -> DataFrame:
    """Open invoices with the company, kind and codes their payment needs."""
    transaction, currency = F.col("ExactTransNo"), F.col("Curr")
    number = F.col("Invoice No").cast("string")
    return open_invoices.select(
        F.col("ExactTransNo").alias("transaction"),
        number.alias("invoice_no"),
        currency.alias("currency"),
        money.amount(F.col("Amount Curr")).alias("asked"),
        rules.payment_company(transaction, longest_first).alias("company"),
        rules.payment_company_code(transaction, longest_first).alias("company_code"),
        rules.invoice_kind(number).alias("kind"),
        rules.currency_ledger(currency).alias("ledger"),
    )


def unroutable(invoices: DataFrame) -> DataFrame:
    """Invoices whose transaction names no known company."""
    return invoices.where(F.col("company").isNull())


def _shapes(invoices: DataFrame) -> tuple[list[int], list[int], list[str] | None, list[str] | None]:
    """Lengths of digits-only and of other numbers, and how the ones and the others start.

    The starts are None if there are too many different ones to test for.
    """
    number = F.col("invoice_no")
    shapes = invoices.where(F.length(number) > 0).select(
        number.rlike(r"^\d+$").alias("numeric"),
        F.length(number).alias("size"),
        F.concat_ws(" ", "kind", F.substring(number, 1, LEAD_LENGTH)).alias("start"),
    )
    found = shapes.distinct().limit(MAX_SHAPES + 1).collect()
    digits = sorted({row["start"] for row in found if row["numeric"]})
    others = sorted({row["start"] for row in found if not row["numeric"]})
    if len(found) > MAX_SHAPES:
        found, digits, others = shapes.select("numeric", "size").distinct().collect(), None, None
    numeric = sorted({row["size"] for row in found if row["numeric"]})
    other = sorted({row["size"] for row in found if not row["numeric"]})
    return numeric, other, digits, others


def _pieces(
    headers: DataFrame, kept: Sequence[str], runs: Column, sizes: Sequence[int], starts: list[str] | None
) -> DataFrame:
    """The ``kept`` columns once per piece of the runs that has one of the sizes."""
    run, at, size = F.col("run"), F.col("at"), F.col("size")
    each_run = headers.select(*kept, F.explode(runs).alias("run")).where(F.length(run) >= min(sizes))
    places = F.sequence(F.lit(1), F.length(run) - min(sizes) + 1)
    each_place = each_run.select(*kept, "run", F.explode(places).alias("at"))
    if starts is not None:
        led = [
            F.concat_ws(" ", "kind", F.substr(run, at, F.lit(n))).isin(starts)
            for n in range(1, LEAD_LENGTH + 1)
        ]
        each_place = each_place.where(reduce(lambda a, b: a | b, led))
    literal_sizes = F.array(*[F.lit(n) for n in sizes])
    each_size = each_place.select(*kept, "run", "at", F.explode(literal_sizes).alias("size"))
    return each_size.where(at + size - 1 <= F.length(run)).select(
        *kept, F.substr(run, at, size).alias("invoice_no")
    )


def _candidates(headers: DataFrame, kept: Sequence[str], invoices: DataFrame) -> DataFrame | None:
    """The ``kept`` columns of headers once per invoice number that could occur in their description.

    Contains-matching without comparing every pair: an invoice number occurs in a
    description exactly if it is one of the description's pieces of that length. Digits-only
    numbers need pieces of digit runs only, and places where no wanted number starts are
    dropped at once. The work grows with the headers, not with headers times invoices.
    """
    numeric, other, digits, others = _shapes(invoices)
    text = F.col("postingDescription")
    found = []
    if numeric:
        digit_runs = F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))
        found.append(_pieces(headers, kept, digit_runs, numeric, digits))
    if other:
        found.append(_pieces(headers, kept, F.array(text), other, others))
    return reduce(DataFrame.unionByName, found) if found else None


def _first_places(
    headers: DataFrame, invoices: DataFrame, arrival: Sequence[str]
) -> DataFrame | None:
    """Per (company, kind, invoice number) the arrival columns of the first header mentioning it.

    Only those columns are expanded. They are cut down to the wanted numbers and to one per
    number in the map tasks before anything is shuffled, so a number that occurs everywhere
    stays cheap. The cut compares 64-bit hashes, which keeps the broadcast small; a number let
    through by a collision finds no invoice to join. Wanted numbers too many to broadcast cut
    by a sieve of their bits first and exactly once one place per number is left.
    """
    candidates = _candidates(headers, ["company", "kind", *arrival], invoices)
    if candidates is None:
        return None
    wanted = invoices.select(*MATCH_KEYS).dropna()
    hashes = wanted.select(F.xxhash64(*MATCH_KEYS).alias("_key"))
    if fits_broadcast(hashes, MAX_WANTED) or fits_broadcast(hashes.distinct(), MAX_WANTED):
        found = F.broadcast(hashes.distinct())
        hits = candidates.withColumn("_key", F.xxhash64(*MATCH_KEYS)).join(found, "_key", "left_semi")
        first = first_per_key(hits.drop("_key"), MATCH_KEYS, arrival)
    else:
        first = present(first_per_key(sieved(candidates, wanted, MATCH_KEYS), MATCH_KEYS, arrival), wanted, MATCH_KEYS)
    return written_once(first, "first-places")


def first_headers(
    headers: DataFrame, invoices: DataFrame, arrival: Sequence[str] = ("no", "id")
) -> DataFrame:
    """Per (company, kind, invoice number) the first header mentioning the number.

    Headers are fetched by company, kind and arrival columns once the first ones are known; if these
    are too many to broadcast, other headers are sieved out before the join shuffles them. Of headers
    equal in those columns the first by all columns is taken.
    """
    carried = [c for c in headers.columns if c not in ("company", "kind")]
    places = _first_places(headers, invoices, arrival)
    if places is None:
        return invoices.sparkSession.createDataFrame(
            [], invoices.select(*MATCH_KEYS).schema
        ).withColumn("header", F.struct(
            *[F.lit(None).cast(headers.schema[c].dataType).alias(c) for c in carried]
        ))
    own = ["company", "kind", *arrival]
    side = places.select("invoice_no", *[F.col(c).alias(f"_{c}") for c in own])
    if fits_broadcast(side):
        side = F.broadcast(side)
    else:
        headers = sieved(headers, places, own)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in own])
    fetched = headers.join(side, same).select(*headers.columns, "invoice_no")
    one = first_per_key(fetched, MATCH_KEYS, arrival)
    return one.select(*MATCH_KEYS, F.struct(*carried).alias("header"))


def closed_only(matched: DataFrame) -> DataFrame:
    """Matches whose header is closed; a header that does not say counts as closed."""
    return matched.where(F.coalesce(F.col("header.closed"), F.lit(True)))


def settled(
    invoices: DataFrame, headers: DataFrame, arrival: Sequence[str] = ("no", "id")
) -> DataFrame:
    """Routed invoices with their first matching header, if it is closed, and what is paid.

    ``headers`` has company, kind, id, no, systemModifiedAt, postingDate, postingDescription,
    currencyFactor, closed and amountIncludingVAT. ``home`` is NULL where another currency has
    no rate or a rate of zero. The invoices are stored once, as they are asked several times.
    """
    known = written_once(invoices.where(F.col("company").isNotNull()), "routed")
    matched = closed_only(known.join(first_headers(headers, known, arrival), MATCH_KEYS))
    booked = money.amount(F.col("header.amountIncludingVAT"))
    factor = F.col("header.currencyFactor").cast(money.FACTOR)
    paid = matched.withColumns({
        "chosen": money.settled_amount(F.col("asked"), booked), "factor": factor,
    })
    return paid.withColumn("home", money.home_amount(F.col("chosen"), F.col("currency"), F.col("factor")))


def without_rate(matched: DataFrame) -> DataFrame:
    """Settled invoices that can't be paid for want of a rate, with the reason."""
    reason = F.when(F.col("factor").isNull(), "exchange rate missing").when(
        F.col("factor") == 0, "exchange rate is zero").otherwise("amount out of range")
    return matched.where(F.col("home").isNull()).select(
        "transaction", "invoice_no", F.col("header.id").alias("externalRefId"), reason.alias("reason")
    )


def payments(
    invoices: DataFrame, headers: DataFrame, arrival: Sequence[str] = ("no", "id")
) -> DataFrame:
    """Payment records of the routed invoices whose first matching header is closed.

    Those of :func:`without_rate` are left out.
    """
    h, currency = "header.", F.col("currency")
    return settled(invoices, headers, arrival).where(F.col("home").isNotNull()).select(
        "transaction",
        "invoice_no",
        last_token(F.col(h + "postingDescription")).alias("invoiceTransNo"),
        F.date_format(h + "postingDate", "yyyy-MM-dd").alias("entryDate"),
        F.date_format(h + "systemModifiedAt", "yyyy-MM-dd").alias("actDate"),
        F.col(h + "id").alias("externalRefId"),
        F.lit(PAY_MODE).alias("payMode"),
        money.two_decimals(F.col("chosen")).alias("currencyAmount"),
        currency.alias("currency"),
        money.two_decimals(F.col("home")).alias("baseCurrencyAmount"),
        money.rate_text(currency, F.col("factor")).alias("bankXCRate"),
        F.col("ledger").cast("string").alias("bankCode"),
        F.col("company_code").alias("companyCode"),
    )


def payment_messages(paid: DataFrame) -> DataFrame:
    """Payments with their XML text."""
    body = F.struct(*[F.col(c) for c in PAYMENT_FIELDS])
    return paid.select(
        F.col("invoice_no").alias("message_id"), element(body, "simplePayment").alias("payload")
    )
