"""Catalog of the extract jobs: what is loaded from where, and how."""

from __future__ import annotations

from dataclasses import dataclass, field

from ledgerhub import fixed_values as fv

REFRESH = "refresh"                # whole table per run
STAGED_REFRESH = "staged refresh"  # same, without the record tag
APPEND = "append above watermark"
APPEND_MERGE = "merge above watermark"
MERGE = "merge"
REPLACE_ALL = "replace, keep repeats"
REPLACE_LAST = "replace, last wins"
INSERT_ABSENT = "insert if absent"  # first of each key, stored rows stay
REPORT = "report"                  # positional CSV, whole table per run


@dataclass(frozen=True)
class Dataset:
    """One extract job. ``kinds`` is (column, values) of rows to keep.

    ``only`` are (column, value) pairs a report's rows must have, by its header names.
    """

    target: str
    source: str
    load: str = REFRESH
    keys: tuple[str, ...] = ()
    entry_no: str | None = None
    changed: str | None = None
    kinds: tuple[str, tuple] | None = None
    width: int | None = None
    skipped: tuple[str, ...] = field(default=())
    only: tuple[tuple[str, str], ...] = ()


def _append(target: str, source: str, entry_no: str) -> Dataset:
    return Dataset(target, source, APPEND, entry_no=entry_no)


def _replace_last(target: str, source: str, key: str, kinds=None) -> Dataset:
    return Dataset(
        target, source, REPLACE_LAST, keys=(key, "Entity"), changed="systemModifiedAt",
        kinds=kinds,
    )


def _report(target: str, source: str, width: int, only=()) -> Dataset:
    return Dataset(target, source, REPORT, width=width, only=only)


_SETTLED = (("DataType", fv.VOYAGE_DATA_TYPE), ("SnapShotType", fv.VOYAGE_SNAPSHOT))
_LINE_TYPES = ("type", tuple(fv.LOADED_LINE_TYPES))

# Table and source names of the extract jobs.
DATASETS = [
    Dataset("BC_GLaccounts", "generalLedgerAccounts"),
    Dataset("BC_purchaseHeader", "purchaseInvoices"),
    Dataset("BC_salesHeader", "salesInvoices"),
    Dataset("BC_Services", "wmsServices"),
    Dataset("BC_bank_customer", "bank_klant"),
    Dataset("BC_bank_vendor", "bank_leverancier"),
    Dataset("BC_Customers", "customers"),
    Dataset("BC_Customers_wide", "customers", STAGED_REFRESH, skipped=("@odata.etag",)),
    Dataset("BC_Vendors", "vendors"),
    Dataset("BC_Vendors_wide", "vendors", STAGED_REFRESH, skipped=("@odata.etag",)),
    _append("BC_CustomerLedgerEntries", "customerLedgerEntries", "entryNo"),
    _append("BC_DetCustomerLedger", "GedetKlantPosten", "Entry_No"),
    _append("BC_DetVendorLedger", "GedetLeveranciersPosten", "Entry_No"),
    Dataset(
        "BC_GLentries", "generalLedgerEntries", APPEND_MERGE, keys=("id", "Entity"),
        entry_no="entryNo",
    ),
    Dataset("BC_GLbudget", "Grootboekbudgetposten", STAGED_REFRESH),
    _append("BC_VendorLedgerEntries", "vendorLedgerEntries", "entryNo"),
    _append("BC_bankledger", "bankposten", "Entry_No"),
    _append("BC_wmsServiceLedger", "dienstpost", "Entry_No"),
    Dataset("BC_NoSerieLines", "nrreeksregels"),
    Dataset(
        "BC_PurchaseInvoiceHeader", "purchaseInvoiceHeaders", REPLACE_ALL,
        keys=("no", "Entity"), changed="systemModifiedAt",
    ),
    _replace_last("BC_SalesInvoiceHeader", "salesInvoiceHeaders", "no"),
    Dataset("BC_wmsCarrierContent", "wmsCarrierContent"),
    Dataset("BC_wmsCustomerItems", "wmsCustomerItems"),
    Dataset("BC_wmsDCL", "wmsDocumentContainers"),
    _replace_last("BC_wmsDH", "wmsDocumentHeaders", "no"),
    _replace_last("BC_wmsDL", "wmsDocumentLines", "id", _LINE_TYPES),
    Dataset("BC_wmsDPL", "wmsDocumentPackageLines"),
    Dataset("BC_wmsItemLedger", "wmsItemLedgerEntries"),
    _replace_last("BC_wmsPDH", "wmsPostedDocumentHeaders", "no"),
    _replace_last("BC_wmsPDL", "wmsPostedDocumentLines", "id", _LINE_TYPES),
    Dataset(
        "BC_wmsRecordLink", "wmsRecordLinks", MERGE, keys=("id", "Entity"), changed="created",
        kinds=("tableNo", tuple(fv.LINKED_TABLES)),
    ),
    Dataset(
        "BC_wmsRecordLink2", "doc_attachements", kinds=("Table_ID", (fv.ATTACHMENT_TABLE,))
    ),
    _report("VS_voyages", "whs_voyage", 154),
    _report("VS_fixture", "whs_fixtures", 62),
    _report("VS_voyage_cargoes", "whs_voyage_cargo", 300),
    _report("VS_voyage_it", "whs_voyage_it", 76),
    _report("VS_voyage_pnl", "whs_voyage_pnl", 208),
    _report("VS_voyagev3", "VoyageV3", 6, _SETTLED),
    Dataset("BC_GLaccounts_mapping", "Ledgernummer"),
]


def dataset(target: str) -> Dataset:
    """The catalog entry of a target table."""
    for entry in DATASETS:
        if entry.target == target:
            return entry
    raise KeyError(target)
