"""Amount expressions on decimals; halves round to even."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerhub.fixed_values import AMOUNT_TOLERANCE, HOME_CURRENCY

AMOUNT = "decimal(18,2)"
FACTOR = "decimal(38,18)"
_FACTOR_PLACES = 18


def amount(value: Column) -> Column:
    return value.try_cast(AMOUNT)


def two_decimals(value: Column) -> Column:
    """Amount as text with two decimals."""
    return value.cast(AMOUNT).cast("string")


def settled_amount(asked: Column, booked: Column) -> Column:
    """The asked amount if the booked one differs by rounding only, else the booked one."""
    close = F.abs(asked - booked) <= F.lit(AMOUNT_TOLERANCE).cast("decimal(7,6)")
    return F.when(close, asked).otherwise(booked)


def divided(value: Column, factor: Column) -> Column:
    """Amount divided by a rate, to whole cents; exact, with halves to even.

    NULL where the rate is missing or zero.
    """
    whole = "decimal(38,0)"
    factor = factor.cast(FACTOR)
    # cents and rate as whole numbers; the amount's 18 digits and the rate's places just fit
    cents = (F.abs(value.cast(AMOUNT)) * 100).cast("decimal(20,0)")
    top = (cents * F.lit(10**_FACTOR_PLACES).cast("decimal(19,0)")).cast(whole)
    digits = F.replace(F.abs(factor).cast("string"), F.lit("."), F.lit(""))
    by = F.when(factor != 0, digits.cast(whole))
    rest = top % by
    quotient = F.try_divide(top - rest, by).cast(whole)
    up = (rest > by - rest) | ((rest == by - rest) & (quotient % 2 == 1))
    rounded = (quotient + F.when(up, 1).otherwise(0)).try_cast("decimal(20,0)")
    sign = F.when((value < 0) != (factor < 0), -1).otherwise(1)
    return (rounded * F.lit("0.01").cast("decimal(3,2)") * sign).try_cast(AMOUNT)


def home_amount(value: Column, currency: Column, factor: Column) -> Column:
    """Amount in home currency; the home currency itself is not divided.

    NULL where another currency has no rate or a rate of zero.
    """
    return F.when(currency == HOME_CURRENCY, value.cast(AMOUNT)).otherwise(divided(value, factor))


def rate_text(currency: Column, factor: Column) -> Column:
    """Exchange rate as text, all places that count; ``1`` for the home currency."""
    plain = F.regexp_replace(factor.cast(FACTOR).cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(currency == HOME_CURRENCY, F.lit("1")).otherwise(plain)


def gap(a: Column, b: Column) -> Column:
    """Absolute difference, missing sides count as zero."""
    return F.abs(F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))
