"""Scalar expressions against hand-made cases."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerhub.functions import money, rules, text, times, xml


@pytest.fixture
def value(spark):
    """Value of an expression over one literal row."""
    def evaluated(build, *literals):
        columns = [F.lit(v) for v in literals]
        return spark.range(1).select(build(*columns).alias("x")).first()["x"]

    return evaluated


def test_key_prefix(value):
    assert value(text.key_prefix, "4000|x|y") == "4000"
    assert value(text.key_prefix, "4000") is None


def test_last_token(value):
    assert value(text.last_token, "Invoice VS-2024-8812") == "8812"
    assert value(text.last_token, "plain") == "plain"
    assert value(text.last_token, "") is None


@pytest.mark.parametrize("answer, expected", [
    ("﻿ 123 ", 123), ("abc", None), ("", None), ("12a34", 12), ("9" * 30, None),
])
def test_first_number(value, answer, expected):
    assert value(text.first_number, answer) == expected


@pytest.mark.parametrize("name, expected", [
    ("[open]", "open"), ("[@odata.etag]", "etag"), ("ODataEtag", "etag"), ("OdataEtag", "etag"),
    ("odata.etag", "etag"), ("_x0033_PL_Vendor_No", "3PL_Vendor_No"), ("lineNo", "lineNo"),
])
def test_plain_name(name, expected):
    assert text.plain_name(name) == expected


@pytest.mark.parametrize("given, expected", [
    ("2024-05-01", date(2024, 5, 1)), ("2024-5-1", date(2024, 5, 1)), ("2024-13-01", None),
    ("", None), ("2024-05-01 10:00", None), ("24-05-01", None),
])
def test_strict_date(value, given, expected):
    assert value(times.strict_date, given) == expected


def test_real_time(value):
    build = lambda d, t: times.real_time(d.cast("date"), t)
    assert value(build, "1753-01-01", "10:00:00") is None
    assert value(build, "2024-05-01", None) == datetime(2024, 5, 1)
    assert value(build, "2024-05-01", "10:20:30") == datetime(2024, 5, 1, 10, 20, 30)


def test_minute_stamp_day(value):
    assert value(times.minute_stamp_day, "2024-05-01 10:20") == "2024-05-01"
    assert value(times.minute_stamp_day, "2024-05-01 10:20:00") == ""
    assert value(times.minute_stamp_day, None) == ""


def test_whole_minutes(value):
    start = datetime(2024, 1, 1, 10, 0, 30)
    assert value(times.whole_minutes, start, datetime(2024, 1, 1, 10, 2, 29)) == 1


def test_iso_day(value):
    assert value(times.iso_day, "2024-05-01T10:20:00Z") == "2024-05-01"


D = Decimal


@pytest.mark.parametrize("booked, expected", [("100.01", "100.00"), ("100.02", "100.02"), ("99.99", "100.00")])
def test_settled_amount(value, booked, expected):
    assert value(money.settled_amount, D("100.00"), D(booked)) == D(expected)


def test_time_of_a_missing_day(value):
    build = lambda d, t: times.at_time(d.cast("date"), t)
    assert value(build, None, "12:00:00") is None and value(build, "2024-01-02", None) is not None


def test_home_amount(value):
    factor = D("1.100000")
    assert value(money.home_amount, D("100.00"), "USD", factor) == D("90.91")
    assert value(money.home_amount, D("100.00"), "EUR", factor) == D("100.00")
    assert value(money.home_amount, D("0.05"), "USD", D("2.000000")) == D("0.02")
    assert value(money.rate_text, "EUR", factor) == "1"
    assert value(money.rate_text, "USD", factor) == "1.1"
    assert value(money.rate_text, "USD", D("0.9234567891")) == "0.9234567891"
    assert value(money.rate_text, "USD", D("1")) == "1.0"
    assert value(money.home_amount, D("1000000.00"), "USD", D("0.9234567891")) == D("1082887.70")
    assert value(money.home_amount, D("-0.15"), "USD", D("2.000000")) == D("-0.08")
    assert value(money.home_amount, D("1.00"), "USD", D("0")) is None
    assert value(money.home_amount, D("1.00"), "EUR", D("0")) == D("1.00")


def test_two_decimals(value):
    assert value(money.two_decimals, D("7")) == "7.00"


@pytest.mark.parametrize("transaction, company, code", [
    ("XVLIE1", "Hartel", "VLIET"), ("IIVLIE1", "Hartel", "VLIET"), ("MAAS1", "Geervliet", "MAASVL"),
    ("COA9", "Chartering", "COASTA"), ("HNV9", "Chartering", "HNV BV"), ("ZZZ", None, None),
    ("IIVL9", None, "IIVLIE"),
])
def test_payment_routing(value, transaction, company, code):
    assert value(rules.payment_company, transaction) == company
    assert value(rules.payment_company_code, transaction) == code


def test_payment_routing_longest_first(value):
    assert value(lambda t: rules.payment_company(t, longest_first=True), "IIVLIE1") == "Vliet2"


def test_small_rules(value):
    assert value(rules.invoice_kind, "1234") == "salesInvoiceHeaders"
    assert value(rules.invoice_kind, "2234") == "purchaseInvoiceHeaders"
    assert value(rules.currency_ledger, "GBP") == 19300
    assert value(rules.currency_ledger, "XXX") is None
    assert value(rules.agency_path, "Maripro Belgium BV") == "Maripro%20Belgium"
    assert value(rules.agency_company, "FSA") is None


@pytest.mark.parametrize("code, group", [("NL", "BINNENLAND"), ("DE", "EU"), ("US", "EXPORT")])
def test_country_group(value, code, group):
    assert value(rules.country_group, code) == group


def test_xml_is_escaped_and_null_is_empty(spark):
    body = spark.sql("SELECT 'A&B <x>' AS vessel, CAST(NULL AS STRING) AS port")
    made = body.select(xml.element(F.struct("vessel", "port"), "m").alias("x")).first()["x"]
    assert made.replace("&gt;", ">") == "<m><vessel>A&amp;B &lt;x></vessel><port></port></m>"


def test_prefixed_and_soap(spark):
    plain = F.lit("<Message><a>1 &lt; 2</a></Message>")
    row = spark.range(1).select(
        xml.prefixed(plain, "Message", "ns0", "urn:x").alias("p"), xml.soap_message(F.lit("<m/>")).alias("s")
    ).first()
    assert row["p"] == '<ns0:Message xmlns:ns0="urn:x"><ns0:a>1 &lt; 2</ns0:a></ns0:Message>'
    assert "<![CDATA[<m/>\n    ]]>" in row["s"]
