"""New port calls as ERP documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ledgerhub import fixed_values as fv
from ledgerhub.functions import rules
from ledgerhub.functions.text import or_blank
from ledgerhub.functions.times import at_time, day_text, real_time
from ledgerhub.functions.xml import element, prefixed, soap_message
from ledgerhub.operators.latest import last_per_key
from ledgerhub.operators.presence import absent_from_large
from ledgerhub.scratch import written_once
from ledgerhub.sizing import distinct_within


def recent_portcalls(
    history: DataFrame,
    portcall: DataFrame,
    setup: DataFrame,
    vessel: DataFrame,
    route: DataFrame,
    harbour: DataFrame,
    run_date: str,
    days: int = fv.PORTCALL_LOOKBACK_DAYS,
) -> DataFrame:
    """Port calls created within the look-back, with vessel, times and ports.

    History is filtered first; port calls and routes are cut down to what is left of it
    before they join, unshuffled while that is measured small. The route type belongs to
    the outer join, so a port call without such a route stays.
    """
    since = F.date_sub(F.lit(run_date).cast("date"), days)
    created = history.where(
        (F.col("INFO") == fv.PORTCALL_EVENT) & (F.col("CHANGE_DATE") > since)
    ).select("PORTCALL_ID", "CHANGE_DATE", "CHANGE_TIME")
    wanted = distinct_within(created.select("PORTCALL_ID").dropna())
    calls = created.join(
        portcall.withColumnRenamed("ID", "PORTCALL_ID").join(wanted, "PORTCALL_ID", "left_semi"),
        "PORTCALL_ID",
    )
    route = route.join(wanted, "PORTCALL_ID", "left_semi")
    calls = calls.join(setup.select(F.col("ID").alias("SETUP_ID"), "AGENT"), "SETUP_ID")
    calls = calls.join(
        vessel.select(F.col("ID").alias("VESSEL_ID"), F.col("NAME").alias("vessel")), "VESSEL_ID"
    )
    calls = _with_port(calls, route, harbour, fv.LAST_PORT_TYPE, "LastPort")
    calls = _with_port(calls, route, harbour, fv.NEXT_PORT_TYPE, "NextPort")
    return calls.select(
        F.col("AGENT").alias("Agency"),
        F.col("PORTCALL_NUMBER").alias("PortCallNumber"),
        F.upper("vessel").alias("VesselName"),
        or_blank(F.upper("VOY")).alias("VoyageNumber"),
        real_time(F.col("ETA_DATE"), F.col("ETA_TIME")).alias("ETA"),
        real_time(F.col("ETD_DATE"), F.col("ETD_TIME")).alias("ETD"),
        "LastPort", "LastPortLOCODE", "NextPort", "NextPortLOCODE",
        at_time(F.col("CHANGE_DATE"), F.col("CHANGE_TIME")).alias("Created"),
    )


def newest_first(calls: DataFrame) -> DataFrame:
    """Listing order: highest port-call number first."""
    return calls.orderBy(F.col("PortCallNumber").desc())


def _with_port(
    calls: DataFrame, route: DataFrame, harbour: DataFrame, kind: int, name: str
) -> DataFrame:
    legs = route.where(F.col("TYPE") == kind).select(
        "PORTCALL_ID", F.col("HARBOUR_ID").alias("_harbour"), F.col("NAME").alias(name)
    )
    codes = harbour.select(F.col("ID").alias("_harbour"), F.col("LOCODE").alias(name + "LOCODE"))
    return (
        calls.join(legs, "PORTCALL_ID", "left").join(codes, "_harbour", "left").drop("_harbour")
    )


def unsent(
    calls: DataFrame,
    documents: DataFrame,
    agencies: Iterable[str] = tuple(fv.AGENCY_COMPANIES),
) -> DataFrame:
    """Port calls of the target agencies whose company holds no document for them yet.

    A port call is sent once: of several changes or legs the last change counts, and among
    equal times the row that is last by all its columns. ``documents`` has company and attribute06, the port call a document was made from. The
    port calls are few and stored once, so that cutting down the documents to them does not
    repeat their joins.
    """
    targeted = calls.where(F.col("Agency").isin(list(agencies))).withColumn(
        "company", rules.agency_company(F.col("Agency"))
    )
    key = ["company", "PortCallNumber"]
    targeted = written_once(last_per_key(targeted, key, ["Created"]), "portcalls")
    made = documents.select("company", F.col("attribute06").alias("PortCallNumber"))
    return absent_from_large(targeted, made, key)


def documents_of(calls: DataFrame, run_date: str) -> DataFrame:
    """Flat document records; all text, missing values empty."""
    departure = day_text(F.col("ETD"))
    return calls.select(
        F.col("PortCallNumber").alias("MessageID"),
        F.lit(run_date).alias("CreationDateTime"),
        F.lit(fv.PORTCALL_ACTION).alias("ProcesAction"),
        F.lit(fv.PORTCALL_PARTNER).alias("FromTradingPartner"),
        F.col("Agency").alias("ToTradingPartner"),
        F.lit(fv.PORTCALL_STATUS).alias("StatusCode"),
        F.lit(fv.PORTCALL_PARTNER).alias("CustomerNo"),
        departure.alias("PostingDate"),
        F.col("PortCallNumber").alias("ExternalDocumentNo"),
        departure.alias("DeliveryDate"),
        departure.alias("EstimatedDepartureDate"),
        F.lit(fv.PORTCALL_ORDER_TYPE).alias("OrderTypeCode"),
        or_blank(F.col("LastPort")).alias("PortFrom"),
        or_blank(F.col("NextPort")).alias("PortTo"),
        or_blank(F.col("VesselName")).alias("VesselNo"),
        F.col("VoyageNumber").alias("VoyageNo"),
        F.col("PortCallNumber").alias("Attribute06"),
    )


def document_messages(documents: DataFrame) -> DataFrame:
    """Documents with their message: XML inside the posting envelope."""
    header = F.struct(
        "MessageID", "CreationDateTime", "ProcesAction", "FromTradingPartner", "ToTradingPartner"
    )
    document = F.struct(
        "StatusCode",
        F.struct(F.col("CustomerNo").alias("No")).alias("Customer"),
        "PostingDate", "ExternalDocumentNo", "DeliveryDate", "EstimatedDepartureDate",
        "OrderTypeCode", "PortFrom", "PortTo", "VesselNo", "VoyageNo", "Attribute06",
    )
    message = F.struct(
        header.alias("Header"), F.struct(document.alias("Document")).alias("Documents")
    )
    xml = prefixed(
        element(message, "Message"), "Message", fv.PORTCALL_PREFIX, fv.PORTCALL_NAMESPACE
    )
    return documents.select(
        F.col("MessageID").alias("message_id"),
        rules.agency_path(F.col("ToTradingPartner")).alias("endpoint"),
        soap_message(xml).alias("payload"),
    )
