"""Jobs against hand-made cases and brute force."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerhub.plans import (
    alerts, balance, count_check, mapping_check, payments, portcalls, posting_groups, relations, run_log,
)

D = Decimal


@pytest.fixture
def frame(spark):
    return spark.createDataFrame


def test_balance_check(frame, rows):
    accounts = frame([("4000", "A"), ("4000", "A"), ("5000", "A")], "no STRING, Entity STRING")
    api = frame(
        [("4000", "A", D(10), "Posting"), ("5000", "A", D(3), "Posting"), ("4000", "A", D(99), "Heading")],
        "no STRING, Entity STRING, balance DECIMAL(18,2), apiAccountType STRING",
    )
    gl = frame(
        [("4000", "A", D(4)), ("4000", "A", D(6)), ("6000", "A", D(1))],
        "gLAccountNo STRING, Entity STRING, amount DECIMAL(18,2)",
    )
    fact = frame(
        [("4000|x", "c1", D(4)), ("4000|y", "c1", D(5)), ("4000", "c1", D(7)), ("4000|x", "gone", D(8))],
        "DK_DimGrootboek STRING, DK_DimCompany STRING, bedrag DECIMAL(18,2)",
    )
    dim = frame([("c1", "A")], "Company STRING, `Naam database` STRING")
    mart = balance.datamart_rows(fact, dim)
    checked = balance.balance_check(
        accounts, balance.source_amounts(api), balance.staging_amounts(gl), balance.datamart_amounts(mart)
    )
    assert rows(checked) == [
        ("4000", "A", D("10.00"), D("10.00"), D("9.00"), D("1.00")),
        ("5000", "A", D("3.00"), D("0.00"), D("0.00"), D("3.00")),
    ]
    assert rows(balance.datamart_rejects(mart)) == [
        ("no account prefix", 1, D("7.00")), ("no company", 1, D("8.00")),
    ]
    assert balance.deviations(checked).count() == 2


def test_deviation_is_zero_exactly_when_all_agree(frame):
    random.seed(3)
    keys = [(str(i), "A") for i in range(60)]
    def sums():
        return [(a, e, D(random.randint(0, 2))) for a, e in keys]

    ddl = "account STRING, Entity STRING, amount DECIMAL(18,2)"
    s, t, m = frame(sums(), ddl), frame(sums(), ddl), frame(sums(), ddl)
    checked = balance.balance_check(frame(keys, "no STRING, Entity STRING"), s, t, m)
    assert checked.count() == len(keys)
    for r in checked.collect():
        same = r["API_Amount"] == r["Staging_Amount"] == r["Datamart_Amount"]
        assert (r["Deviation"] == 0) == same


def test_count_check(frame, rows):
    names = frame([("A",), ("B",), ("C",), ("D",)], "name STRING")
    source = frame([("A", 5), ("B", 7), ("C", None)], "Entity STRING, source_rows BIGINT")
    table = frame([("A", i) for i in range(5)] + [("B", i) for i in range(6)] + [("D", 1)], "Entity STRING, entryNo INT")
    checked = count_check.count_check(names, source, table)
    assert rows(checked, "Entity", "status", "difference") == [
        ("A", "equal", 0), ("B", "mismatch", 1), ("C", "unknown", None), ("D", "mismatch", 1),
    ]
    assert rows(count_check.check_totals(checked)) == [("equal", 1, 0), ("mismatch", 2, 2), ("unknown", 1, 0)]
    pulled = frame([("A", 99), ("B", 3), ("B", 6), ("C", 9)], "Entity STRING, entryNo INT")
    assert rows(count_check.repair_rows(names, source, pulled, table, "entryNo")) == [("B", 6)]


def test_missing_accounts(frame, rows):
    accounts = frame(
        [("0100", "A"), ("100", "A"), ("0100", "B"), ("777", "Consol HV")], "no STRING, Entity STRING"
    )
    mapping = frame([("100",), (None,)], "no STRING")
    missing = mapping_check.missing_accounts(accounts, mapping, excluded=["Consol HV "])
    assert rows(missing) == [("0100",)]
    assert rows(mapping_check.missing_message(missing), "no", "error_details", "total_missing") == [
        ("0100", "Value missing in Excel: 0100", None), (None, "Values missing in Excel: 1", 1)
    ]


@pytest.mark.parametrize("count", [1, 1000, 1001])
def test_missing_messages_have_one_shape(frame, count):
    missing = frame([(str(i),) for i in range(count)], "no STRING")
    messages = mapping_check.missing_message(missing).collect()
    assert sorted(m["no"] for m in messages if m["no"]) == sorted(str(i) for i in range(count))
    assert [m["total_missing"] for m in messages if m["no"] is None] == [count]
    assert mapping_check.missing_message(missing.where("no = 'x'")).count() == 0


def test_posting_groups(frame, rows):
    countries = frame(
        [("all", "NL", "n"), ("all", "DE", "d"), ("all", "US", "u"), ("all", "FR", None)],
        "company STRING, code STRING, displayName STRING",
    )
    ddl = "company STRING, no STRING, name STRING, countryRegionCode STRING, {} STRING, genBusPostingGroup STRING, vatBusPostingGroup STRING"
    customers = frame(
        [("all", "1", "x", "DE", "EU", "EU", "EXPORT"), ("all", "2", "y", "US", "EXPORT", "EXPORT", "EXPORT"),
         ("all", "3", "z", None, "EU", None, "Unknown"), ("all", "4", "f", "FR", "Unknown", "Unknown", "EU")],
        ddl.format("customerPostingGroup"),
    )
    vendors = frame([("all", "9", "v", "NL", "EU", "BINNENLAND", "BINNENLAND")], ddl.format("vendorPostingGroup"))
    found = posting_groups.posting_group_mismatches(customers, vendors, countries)
    assert rows(found, "Src", "Entity", "group_name", "actual", "correct") == [
        ("Customer", "1", "vatBusPostingGroup", "EXPORT", "EU"),
        ("Customer", "3", "customerPostingGroup", "EU", "Unknown"),
        ("Customer", "3", "genBusPostingGroup", None, "Unknown"),
        ("Customer", "4", "vatBusPostingGroup", "EU", "Unknown"),
        ("Vendor", "9", "vendorPostingGroup", "EU", "BINNENLAND"),
    ]
    wide = posting_groups.wide_report(found)
    assert "CorrectVendorpostinggroup" in wide.columns
    assert rows(wide.where("Src = 'Vendor'"), "vendorPostingGroup", "vatBusPostingGroup") == [("EU", None)]


def test_stuck_messages(spark, rows):
    messages = spark.sql(
        "SELECT * FROM VALUES ('New', 'xCDMx', TIMESTAMP '2024-01-01 09:54:59', 'A'),"
        " ('New', 'CDM', TIMESTAMP '2024-01-01 09:55:00', 'B'), ('New', 'CDM', TIMESTAMP '2024-01-01 09:56:00', 'B'),"
        " ('Failed', 'CDM', TIMESTAMP '2024-01-01 09:00:00', 'C'), ('New', 'EDI', TIMESTAMP '2024-01-01 09:00:00', 'D')"
        " t(status, messageType, receivedAt, Entity)"
    )
    now = F.lit(datetime(2024, 1, 1, 10))
    assert rows(alerts.stuck_messages(messages, "b=", now), "company_name", "row_count", "link") == [
        ("A", 1, "b=A&page=11242113")
    ]
    assert rows(alerts.failed_messages(messages, "b="), "company_name") == [("C",)]


def test_failed_jobs_and_partners(frame, rows):
    queue = frame([("Error", "A"), ("Error", "A"), ("Ready", "B"), (None, "C")], "Status STRING, Entity STRING")
    assert rows(alerts.failed_jobs(queue, "b=")) == [("A", 2, "2 error(s) found", "b=A&page=672")]
    assert rows(alerts.failed_jobs(queue, "b=", threshold=2)) == []
    registry = frame([("A",), ("B",), ("C",), ("Consol HV",)], "name STRING")
    partners = frame([("p", "A"), ("", "B"), (None, "B")], "Central_Layer_Partner_ID STRING, Entity STRING")
    assert rows(alerts.companies_without_partner(registry, partners, ["Consol HV"]), "company_name") == [("B",), ("C",)]


def test_relation_growth(spark, frame, rows):
    names = frame([("A",), ("B",)], "name STRING")
    ddl = "systemCreatedAt TIMESTAMP, Entity STRING"
    day = [datetime(2024, 1, 2, 0, 0), datetime(2024, 1, 2, 23, 59, 59), datetime(2024, 1, 3)]
    customers = frame([(d, "A") for d in day] + [(None, "A"), (day[0], "Z")], ddl)
    vendors = frame([(day[2], "B")], ddl)
    grown = relations.relation_growth(names, customers, vendors, "2024-01-02")
    assert rows(grown.drop("date")) == [("A", 2, 4, 0, 0), ("B", 0, 0, 0, 1)]


def brute_force(invoices, headers):
    """Every invoice against every header, in plain Python."""
    found = {}
    for number, company, kind in invoices:
        hits = [h for h in headers if h[0] == company and h[1] == kind and h[3] and number in h[3]]
        if hits:
            first = min(hits, key=lambda h: (h[2], h[4]))
            found[(company, kind, number)] = first[4]
    return found


def test_contains_match_equals_brute_force(frame):
    random.seed(11)
    text = lambda: "".join(random.choice("012AB-") for _ in range(random.randint(0, 14)))
    headers = [
        (random.choice("XY"), random.choice("sp"), f"n{random.randint(0, 30):02d}", text() or None, f"id{i:04d}")
        for i in range(300)
    ]
    invoices = [
        (n, random.choice("XY"), random.choice("sp"))
        for n in ["0", "12", "A", "AB", "0-1", "2B", "0120", "999999999999999999", "B-"] + [text() or "0" for _ in range(80)]
    ]
    header_frame = frame(headers, "company STRING, kind STRING, no STRING, postingDescription STRING, id STRING")
    invoice_frame = frame(invoices, "invoice_no STRING, company STRING, kind STRING")
    got = payments.first_headers(header_frame.repartition(7), invoice_frame)
    matched = {(r["company"], r["kind"], r["invoice_no"]): r["header"]["id"] for r in got.collect()}
    assert matched == brute_force(invoices, headers)


@pytest.mark.parametrize("shapes,wanted", [(0, 10**6), (1, 10**6), (10**6, 0), (10**6, 3)])
def test_contains_match_at_both_sides_of_its_bounds(frame, monkeypatch, shapes, wanted):
    """Too many number shapes or wanted numbers choose another plan, not other rows."""
    monkeypatch.setattr(payments, "MAX_SHAPES", shapes)
    monkeypatch.setattr(payments, "MAX_WANTED", wanted)
    headers = [("X", "s", f"n{i:03d}", f"No {i % 40} and A{i % 7}-0{i}", f"id{i}") for i in range(200)]
    invoices = [(str(n), "X", "s") for n in range(0, 60, 3)] + [("A3", "X", "s"), ("-0", "X", "s"), ("A3-", "X", "p")]
    got = payments.first_headers(
        frame(headers, "company STRING, kind STRING, no STRING, postingDescription STRING, id STRING"),
        frame(invoices, "invoice_no STRING, company STRING, kind STRING"),
    )
    matched = {(r["company"], r["kind"], r["invoice_no"]): r["header"]["id"] for r in got.collect()}
    assert matched == brute_force(invoices, headers)


def test_contains_match_with_a_hot_number(frame):
    """A third of all headers mention one number; it still yields one header per number."""
    headers = [("X", "s", f"n{i:05d}", f"Invoice {7 if i % 3 == 0 else i + 1000}", f"id{i:05d}") for i in range(6000)]
    invoices = [("7", "X", "s"), ("1001", "X", "s"), ("none", "X", "s")]
    got = payments.first_headers(
        frame(headers, "company STRING, kind STRING, no STRING, postingDescription STRING, id STRING"),
        frame(invoices, "invoice_no STRING, company STRING, kind STRING"),
    )
    matched = {(r["company"], r["kind"], r["invoice_no"]): r["header"]["id"] for r in got.collect()}
    assert matched == brute_force(invoices, headers)


def test_payments(spark, frame, rows):
    open_invoices = frame(
        [("XVLIE1", "1001", "EUR", D("100.00")), ("HNV1", "2002", "USD", D("100.00")), ("ZZZ", "1003", "EUR", D(1)),
         ("MAAS1", "2004", "EUR", D(1)), ("COA1", "2005", "NOK", D("5.00"))],
        "ExactTransNo STRING, `Invoice No` STRING, Curr STRING, `Amount Curr` DECIMAL(18,2)",
    )
    sales, purchase = "salesInvoiceHeaders", "purchaseInvoiceHeaders"
    made = spark.sql(
        "SELECT * FROM VALUES"
        f" ('Hartel', '{sales}', 'i1', 'n1', 'Invoice 1001-VS-8812', 0.0, true, 100.01),"
        f" ('Chartering', '{purchase}', 'i2', 'n1', 'Invoice VS-2002', 1.1, CAST(NULL AS BOOLEAN), 200.00),"
        f" ('Geervliet', '{purchase}', 'i3', 'n1', 'Invoice 2004', 1.0, false, 1.00),"
        f" ('Geervliet', '{purchase}', 'i4', 'n2', 'Invoice 2004', 1.0, true, 1.00),"
        f" ('Hartel', '{purchase}', 'i5', 'n1', 'Invoice 2005', 1.0, true, 5.00)"
        " t(company, kind, id, no, postingDescription, currencyFactor, closed, amountIncludingVAT)"
    ).withColumns({"systemModifiedAt": F.lit("2024-05-02").cast("timestamp"), "postingDate": F.lit("2024-05-01").cast("date")})
    routed = payments.routed(open_invoices)
    assert rows(payments.unroutable(routed), "invoice_no") == [("1003",)]
    paid = payments.payments(routed, made)
    assert rows(paid, *payments.PAYMENT_FIELDS) == [
        ("2002", "2024-05-01", "2024-05-02", "i2", "WT", "200.00", "USD", "181.82", "1.1", "19400", "HNV BV"),
        ("8812", "2024-05-01", "2024-05-02", "i1", "WT", "100.00", "EUR", "100.00", "1", "19200", "VLIET"),
    ]
    message = payments.payment_messages(paid).where("message_id = '1001'").first()["payload"]
    assert message.startswith("<simplePayment><invoiceTransNo>8812</invoiceTransNo><entryDate>")
    assert payments.payments(routed.where("invoice_no = 'x'"), made).count() == 0


def portcall_tables(spark):
    sql = spark.sql
    return {
        "history": sql(
            "SELECT * FROM VALUES (1, DATE '2024-05-09', '08:00:00', 'PortCall created'), (2, DATE '2024-05-03', '08:00:00', 'PortCall created'),"
            " (3, DATE '2024-05-09', '08:00:00', 'changed'), (4, DATE '2024-05-09', '08:00:00', 'PortCall created')"
            " t(PORTCALL_ID, CHANGE_DATE, CHANGE_TIME, INFO)"
        ),
        "portcall": sql(
            "SELECT id AS ID, if(id = 4, 2, 1) AS SETUP_ID, 7 AS VESSEL_ID, concat('P', id) AS PORTCALL_NUMBER, CAST(NULL AS STRING) AS VOY,"
            " DATE '1753-01-01' AS ETA_DATE, '10:00:00' AS ETA_TIME, DATE '2024-05-20' AS ETD_DATE, CAST(NULL AS STRING) AS ETD_TIME"
            " FROM VALUES (1), (2), (3), (4) t(id)"
        ),
        "setup": sql("SELECT * FROM VALUES (1, 'Maripro BV'), (2, 'Maripro Belgium BV') t(ID, AGENT)"),
        "vessel": sql("SELECT 7 AS ID, 'a&b' AS NAME"),
        "route": sql("SELECT 1 AS PORTCALL_ID, 1 AS TYPE, 5 AS HARBOUR_ID, 'Last' AS NAME"),
        "harbour": sql("SELECT 5 AS ID, 'NLRTM' AS LOCODE"),
    }


def test_portcalls(spark, frame, rows):
    calls = portcalls.recent_portcalls(**portcall_tables(spark), run_date="2024-05-10")
    assert rows(calls, "PortCallNumber", "VesselName", "VoyageNumber", "ETA", "ETD", "LastPort", "LastPortLOCODE", "NextPort") == [
        ("P1", "A&B", "", None, datetime(2024, 5, 20), "Last", "NLRTM", None),
        ("P4", "A&B", "", None, datetime(2024, 5, 20), None, None, None),
    ]
    assert [r["PortCallNumber"] for r in portcalls.newest_first(calls).collect()] == ["P4", "P1"]
    documents = frame([("Maripro Belgium", "P1"), ("Maripro Belgium", "P4")], "company STRING, attribute06 STRING")
    new = portcalls.unsent(calls, documents)
    assert rows(new, "PortCallNumber", "company") == [("P1", "Maripro")]
    assert portcalls.unsent(calls, documents, agencies=["other"]).count() == 0
    made = portcalls.documents_of(new, "2024-05-10")
    assert rows(made, "PostingDate", "PortFrom", "PortTo", "StatusCode") == [("2024-05-20", "Last", "", "15-EDI")]
    message = portcalls.document_messages(made).first()
    assert message["endpoint"] == "Maripro"
    assert "<ns0:VesselNo>A&amp;B</ns0:VesselNo>" in message["payload"]
    assert "<ns0:PortTo></ns0:PortTo>" in message["payload"]


def test_run_log(spark, frame, rows):
    start, end = datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 2, 59)
    one = run_log.log_row(spark, "Success", "c", "n", start, end, None, "ok", "A")
    two = run_log.log_row(spark, "Error", "c", "n", start, end, 5, "bad", "A")
    three = run_log.log_row(spark, "Success", "c", "n", start, end, 7, "ok", "B")
    summary = run_log.run_summary(one.unionByName(two).unionByName(three))
    assert rows(summary) == [("A", 1, 1, 0, 4), ("B", 1, 0, 7, 2)]
    assert rows(run_log.run_totals(summary)) == [(1, 7)]


def test_load_check_reads_back(frame, rows):
    batch = frame([("A",), ("A",), ("B",)], "Entity STRING")
    stored = frame([("A",), ("B",), ("C",)], "Entity STRING")
    assert rows(run_log.load_check(batch, stored)) == [
        ("A", 2, 1, "Error"), ("B", 1, 1, "Success"), ("C", 0, 1, "Error"),
    ]
