"""Declared columns of extract jobs.

Names are those of the interface, as they land, since pages are parsed by exact name; the types are
our declaration, text where the name doesn't tell. Each entry has the whole list of its job, the
record tag included if the job stores it, and the time its change filter needs. A job reads and
keeps these columns only. Jobs without an entry (README) take theirs from the caller
(``extract.run_landed``), as do jobs of which more columns are wanted.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field names of the interface as they land, with our types; all that the job's list of columns names
_HEADER = (
    "`@odata.etag` STRING, id STRING, documentType STRING, no STRING, sellToCustomerNo STRING, "
    "sellToCustomerName STRING, billToCustomerNo STRING, billToCustomerName STRING, voyageNo STRING, "
    "movementType STRING, documentDate DATE, postingDate DATE, statusCode STRING, createdDateTime TIMESTAMP, "
    "createdUserID STRING, modifiedDateTime TIMESTAMP, modifiedUserID STRING, announcedDate DATE, "
    "announcedTime STRING, arrivedDate DATE, arrivedTime STRING, departedDate DATE, deliveryDate DATE, "
    "estimatedDepartureDate DATE, vesselNo STRING, orderTypeCode STRING, shortcutDimension2Code STRING, "
    "attribute01 STRING, attribute02 STRING, attribute03 STRING, attribute04 STRING, attribute05 STRING, "
    "attribute06 STRING, attribute07 STRING, attribute08 STRING, attribute09 STRING, attribute10 STRING, "
    "portFromName STRING, portToName STRING, systemModifiedAt TIMESTAMP"
)
_LINE = (
    "`@odata.etag` STRING, id STRING, systemCreatedAt TIMESTAMP, systemModifiedAt TIMESTAMP, documentNo STRING, "
    "lineNo INT, sellToCustomerNo STRING, buyFromVendorNo STRING, currencyCode STRING, "
    "lineAmountLCY DECIMAL(18,2), type STRING, no STRING, quantity DECIMAL(18,6), unitPrice DECIMAL(18,6), "
    "lineAmount DECIMAL(18,2), createdDateTime TIMESTAMP, createdUserID STRING, modifiedDateTime TIMESTAMP, "
    "modifiedUserID STRING, itemCategoryCode STRING, productGroupCode STRING, batchNo STRING, "
    "shortcutDimension2Code STRING, postingDate DATE, invoiceType STRING, invoiceNo STRING, invoiceDate DATE, "
    "purchInvoiceType STRING, purchInvoiceNo STRING, purchInvoiceDate DATE, agreementType STRING, "
    "agreementNo STRING"
)
_COLUMNS = {
    "BC_GLaccounts": (
        "`@odata.etag` STRING, id STRING, systemCreatedAt TIMESTAMP, systemCreatedBy STRING, "
        "systemModifiedAt TIMESTAMP, systemModifiedBy STRING, no STRING, name STRING, searchName STRING, "
        "accountType STRING, globalDimension1Code STRING, globalDimension2Code STRING, accountCategory STRING, "
        "incomeBalance STRING, debitCredit STRING, no2 STRING, comment STRING, blocked BOOLEAN, "
        "directPosting STRING, reconciliationAccount STRING, newPage STRING, noOfBlankLines STRING, "
        "indentation STRING, lastModifiedDateTime TIMESTAMP, lastDateModified DATE, balanceAtDate DECIMAL(18,2), "
        "netChange DECIMAL(18,2), budgetedAmount DECIMAL(18,2), totaling STRING, balance DECIMAL(18,2), "
        "budgetAtDate DECIMAL(18,2), consolTranslationMethod STRING, consolDebitAcc STRING, "
        "consolCreditAcc STRING, genPostingType STRING, genBusPostingGroup STRING, genProdPostingGroup STRING, "
        "debitAmount DECIMAL(18,2), creditAmount DECIMAL(18,2), automaticExtTexts STRING, "
        "budgetedDebitAmount DECIMAL(18,2), budgetedCreditAmount DECIMAL(18,2), taxAreaCode STRING, "
        "taxLiable BOOLEAN, taxGroupCode STRING, vatBusPostingGroup STRING, vatProdPostingGroup STRING, "
        "vatAmt DECIMAL(18,2), additionalCurrencyNetChange STRING, addCurrencyBalanceAtDate DECIMAL(18,2), "
        "additionalCurrencyBalance STRING, exchangeRateAdjustment STRING, addCurrencyDebitAmount DECIMAL(18,2), "
        "addCurrencyCreditAmount DECIMAL(18,2), defaultICPartnerGLAccNo STRING, accountSubcategoryEntryNo BIGINT, "
        "accountSubcategoryDescript STRING, costTypeNo STRING, defaultDeferralTemplateCode STRING, "
        "apiAccountType STRING, omitDefaultDescrInJnl STRING, availableForPurchase3PL STRING, "
        "availableForSales3PL STRING, pictureMediaEditLink STRING, pictureMediaReadLink STRING"
    ),
    "BC_GLentries": (
        "id STRING, systemCreatedAt TIMESTAMP, systemCreatedBy STRING, systemModifiedAt TIMESTAMP, "
        "systemModifiedBy STRING, entryNo BIGINT, gLAccountNo STRING, postingDate DATE, documentType STRING, "
        "documentNo STRING, description STRING, balAccountNo STRING, amount DECIMAL(18,2), "
        "globalDimension1Code STRING, globalDimension2Code STRING, userID STRING, sourceCode STRING, "
        "systemCreatedEntry STRING, priorYearEntry STRING, jobNo STRING, quantity DECIMAL(18,6), "
        "vatAmount DECIMAL(18,2), businessUnitCode STRING, journalBatchName STRING, reasonCode STRING, "
        "genPostingType STRING, genBusPostingGroup STRING, genProdPostingGroup STRING, balAccountType STRING, "
        "transactionNo BIGINT, debitAmount DECIMAL(18,2), creditAmount DECIMAL(18,2), documentDate DATE, "
        "externalDocumentNo STRING, sourceType STRING, sourceNo STRING, noSeries STRING, taxAreaCode STRING, "
        "taxLiable BOOLEAN, taxGroupCode STRING, useTax STRING, vatBusPostingGroup STRING, "
        "vatProdPostingGroup STRING, additionalCurrencyAmount DECIMAL(18,2), "
        "addCurrencyDebitAmount DECIMAL(18,2), addCurrencyCreditAmount DECIMAL(18,2), "
        "closeIncomeStatementDimID STRING, icPartnerCode STRING, reversed BOOLEAN, reversedByEntryNo BIGINT, "
        "reversedEntryNo BIGINT, gLAccountName STRING, journalTemplName STRING, dimensionSetID BIGINT, "
        "shortcutDimension3Code STRING, shortcutDimension4Code STRING, shortcutDimension5Code STRING, "
        "shortcutDimension6Code STRING, shortcutDimension7Code STRING, shortcutDimension8Code STRING, "
        "lastDimCorrectionEntryNo BIGINT, lastDimCorrectionNode STRING, dimensionChangesCount STRING, "
        "prodOrderNo STRING, faEntryType STRING, faEntryNo BIGINT, comment STRING, accountId STRING, "
        "lastModifiedDateTime TIMESTAMP, documentLineNo3PL STRING, wmsDocumentType STRING, wmsDocumentNo STRING, "
        "wmsDocumentLineNo STRING, tmsDocumentType STRING, tmsDocumentNo STRING, tmsDocumentSequenceNo STRING, "
        "tmsDocumentLineNo STRING, ultimo STRING"
    ),
    "BC_CustomerLedgerEntries": (
        "`@odata.etag` STRING, id STRING, systemCreatedAt TIMESTAMP, systemCreatedBy STRING, "
        "systemModifiedAt TIMESTAMP, systemModifiedBy STRING, entryNo BIGINT, customerNo STRING, "
        "postingDate DATE, documentType STRING, documentNo STRING, description STRING, customerName STRING, "
        "currencyCode STRING, amount DECIMAL(18,2), remainingAmount DECIMAL(18,2), originalAmtLCY DECIMAL(18,2), "
        "remainingAmtLCY DECIMAL(18,2), amountLCY DECIMAL(18,2), salesLCY DECIMAL(18,2), profitLCY DECIMAL(18,2), "
        "invDiscountLCY DECIMAL(18,2), sellToCustomerNo STRING, customerPostingGroup STRING, "
        "globalDimension1Code STRING, globalDimension2Code STRING, salespersonCode STRING, userID STRING, "
        "sourceCode STRING, onHold STRING, appliesToDocType STRING, appliesToDocNo STRING, open BOOLEAN, "
        "dueDate DATE, pmtDiscountDate DATE, originalPmtDiscPossible STRING, pmtDiscGivenLCY DECIMAL(18,2), "
        "origPmtDiscPossibleLCY DECIMAL(18,2), positive BOOLEAN, closedByEntryNo BIGINT, closedAtDate DATE, "
        "closedByAmount DECIMAL(18,2), appliesToID STRING, journalTemplName STRING, journalBatchName STRING, "
        "reasonCode STRING, balAccountType STRING, balAccountNo STRING, transactionNo BIGINT, "
        "closedByAmountLCY DECIMAL(18,2), debitAmount DECIMAL(18,2), creditAmount DECIMAL(18,2), "
        "debitAmountLCY DECIMAL(18,2), creditAmountLCY DECIMAL(18,2), documentDate DATE, "
        "externalDocumentNo STRING, calculateInterest STRING, closingInterestCalculated STRING, noSeries STRING, "
        "closedByCurrencyCode STRING, closedByCurrencyAmount DECIMAL(18,2), adjustedCurrencyFactor STRING, "
        "originalCurrencyFactor STRING, originalAmount DECIMAL(18,2), remainingPmtDiscPossible STRING, "
        "pmtDiscToleranceDate DATE, maxPaymentTolerance STRING, lastIssuedReminderLevel STRING, "
        "acceptedPaymentTolerance STRING, acceptedPmtDiscTolerance STRING, pmtToleranceLCY DECIMAL(18,2), "
        "amountToApply DECIMAL(18,2), icPartnerCode STRING, applyingEntry STRING, reversed BOOLEAN, "
        "reversedByEntryNo BIGINT, reversedEntryNo BIGINT, prepayment BOOLEAN, paymentReference STRING, "
        "paymentMethodCode STRING, appliesToExtDocNo STRING, recipientBankAccount STRING, "
        "messageToRecipient STRING, exportedToPaymentFile STRING, dimensionSetID BIGINT, "
        "shortcutDimension3Code STRING, shortcutDimension4Code STRING, shortcutDimension5Code STRING, "
        "shortcutDimension6Code STRING, shortcutDimension7Code STRING, shortcutDimension8Code STRING, "
        "directDebitMandateID STRING"
    ),
    "BC_VendorLedgerEntries": (
        "`@odata.etag` STRING, id STRING, systemCreatedAt TIMESTAMP, systemCreatedBy STRING, "
        "systemModifiedAt TIMESTAMP, systemModifiedBy STRING, entryNo BIGINT, vendorNo STRING, postingDate DATE, "
        "documentType STRING, documentNo STRING, description STRING, vendorName STRING, currencyCode STRING, "
        "amount DECIMAL(18,2), remainingAmount DECIMAL(18,2), originalAmtLCY DECIMAL(18,2), "
        "remainingAmtLCY DECIMAL(18,2), amountLCY DECIMAL(18,2), purchaseLCY DECIMAL(18,2), "
        "invDiscountLCY DECIMAL(18,2), buyFromVendorNo STRING, vendorPostingGroup STRING, "
        "globalDimension1Code STRING, globalDimension2Code STRING, purchaserCode STRING, userID STRING, "
        "sourceCode STRING, onHold STRING, appliesToDocType STRING, appliesToDocNo STRING, open BOOLEAN, "
        "dueDate DATE, pmtDiscountDate DATE, originalPmtDiscPossible STRING, pmtDiscRcdLCY DECIMAL(18,2), "
        "origPmtDiscPossibleLCY DECIMAL(18,2), positive BOOLEAN, closedByEntryNo BIGINT, closedAtDate DATE, "
        "closedByAmount DECIMAL(18,2), appliesToID STRING, journalTemplName STRING, journalBatchName STRING, "
        "reasonCode STRING, balAccountType STRING, balAccountNo STRING, transactionNo BIGINT, "
        "closedByAmountLCY DECIMAL(18,2), debitAmount DECIMAL(18,2), creditAmount DECIMAL(18,2), "
        "debitAmountLCY DECIMAL(18,2), creditAmountLCY DECIMAL(18,2), documentDate DATE, "
        "externalDocumentNo STRING, noSeries STRING, closedByCurrencyCode STRING, "
        "closedByCurrencyAmount DECIMAL(18,2), adjustedCurrencyFactor STRING, originalCurrencyFactor STRING, "
        "originalAmount DECIMAL(18,2), remainingPmtDiscPossible STRING, pmtDiscToleranceDate DATE, "
        "maxPaymentTolerance STRING, acceptedPaymentTolerance STRING, acceptedPmtDiscTolerance STRING, "
        "pmtToleranceLCY DECIMAL(18,2), amountToApply DECIMAL(18,2), icPartnerCode STRING, applyingEntry STRING, "
        "reversed BOOLEAN, reversedByEntryNo BIGINT, reversedEntryNo BIGINT, prepayment BOOLEAN, "
        "creditorNo STRING, paymentReference STRING, paymentMethodCode STRING, appliesToExtDocNo STRING, "
        "recipientBankAccount STRING, messageToRecipient STRING, exportedToPaymentFile STRING, "
        "dimensionSetID BIGINT, shortcutDimension3Code STRING, shortcutDimension4Code STRING, "
        "shortcutDimension5Code STRING, shortcutDimension6Code STRING, shortcutDimension7Code STRING, "
        "shortcutDimension8Code STRING"
    ),
    "BC_DetCustomerLedger": (
        "`@odata.etag` STRING, Entry_No BIGINT, Posting_Date DATE, Entry_Type STRING, Document_Type STRING, "
        "Document_No STRING, Customer_No STRING, Initial_Entry_Global_Dim_1 STRING, "
        "Initial_Entry_Global_Dim_2 STRING, Posting_Group STRING, Currency_Code STRING, Amount DECIMAL(18,2), "
        "Amount_LCY DECIMAL(18,2), Debit_Amount DECIMAL(18,2), Debit_Amount_LCY DECIMAL(18,2), "
        "Credit_Amount DECIMAL(18,2), Credit_Amount_LCY DECIMAL(18,2), Initial_Entry_Due_Date DATE, "
        "User_ID STRING, Source_Code STRING, Reason_Code STRING, Unapplied BOOLEAN, Unapplied_by_Entry_No BIGINT, "
        "Cust_Ledger_Entry_No BIGINT"
    ),
    "BC_DetVendorLedger": (
        "`@odata.etag` STRING, Entry_No BIGINT, Posting_Date DATE, Entry_Type STRING, Document_Type STRING, "
        "Document_No STRING, Vendor_No STRING, Initial_Entry_Global_Dim_1 STRING, "
        "Initial_Entry_Global_Dim_2 STRING, Posting_Group STRING, Currency_Code STRING, Amount DECIMAL(18,2), "
        "Amount_LCY DECIMAL(18,2), Debit_Amount DECIMAL(18,2), Debit_Amount_LCY DECIMAL(18,2), "
        "Credit_Amount DECIMAL(18,2), Credit_Amount_LCY DECIMAL(18,2), Initial_Entry_Due_Date DATE, "
        "User_ID STRING, Source_Code STRING, Reason_Code STRING, Unapplied BOOLEAN, Unapplied_by_Entry_No BIGINT, "
        "Vendor_Ledger_Entry_No BIGINT"
    ),
    "BC_bankledger": (
        "`@odata.etag` STRING, Entry_No BIGINT, Posting_Date DATE, Document_Type STRING, Document_No STRING, "
        "Bank_Account_No STRING, Description STRING, Global_Dimension_1_Code STRING, "
        "Global_Dimension_2_Code STRING, Our_Contact_Code STRING, Currency_Code STRING, Amount DECIMAL(18,2), "
        "Debit_Amount DECIMAL(18,2), Credit_Amount DECIMAL(18,2), RunningBalance DECIMAL(18,2), "
        "Amount_LCY DECIMAL(18,2), Debit_Amount_LCY DECIMAL(18,2), Credit_Amount_LCY DECIMAL(18,2), "
        "RunningBalanceLCY DECIMAL(18,2), Remaining_Amount DECIMAL(18,2), Bal_Account_Type STRING, "
        "Bal_Account_No STRING, Open BOOLEAN, User_ID STRING, Source_Code STRING, Reason_Code STRING, "
        "Reversed BOOLEAN, Reversed_by_Entry_No BIGINT, Reversed_Entry_No BIGINT, Dimension_Set_ID BIGINT, "
        "Shortcut_Dimension_3_Code STRING, Shortcut_Dimension_4_Code STRING, Shortcut_Dimension_5_Code STRING, "
        "Shortcut_Dimension_6_Code STRING, Shortcut_Dimension_7_Code STRING, Shortcut_Dimension_8_Code STRING"
    ),
    "BC_wmsServiceLedger": (
        "`@odata.etag` STRING, Entry_No BIGINT, Posting_Date DATE, Entry_Type STRING, Document_No STRING, "
        "Service_No STRING, Description STRING, User_ID STRING, Source_Code STRING, Reason_Code STRING, "
        "WMS_Document_Type STRING, WMS_Document_No STRING, WMS_Document_Line_No STRING, "
        "Global_Dimension_1_Code STRING, Global_Dimension_2_Code STRING, Gen_Bus_Posting_Group STRING, "
        "Gen_Prod_Posting_Group STRING, Amount DECIMAL(18,2), Amount_LCY DECIMAL(18,2), Currency_Code STRING, "
        "Currency_Factor STRING, VAT_Amount DECIMAL(18,2), Debit_Amount DECIMAL(18,2), "
        "Credit_Amount DECIMAL(18,2), Carrier_Quantity DECIMAL(18,6), Order_Quantity DECIMAL(18,6), "
        "Gross_Weight DECIMAL(18,6), Net_Weight DECIMAL(18,6), Quantity DECIMAL(18,6), "
        "Unit_of_Measure_Code STRING, Qty_per_Unit_of_Measure STRING, Quantity_Base DECIMAL(18,6), "
        "Unit_Price DECIMAL(18,6), Unit_Cost DECIMAL(18,6), Original_Line_Qty STRING, "
        "Original_Unit_Price_Cost STRING, Min_Line_Amount DECIMAL(18,2), Max_Line_Amount DECIMAL(18,2), "
        "Base_Line_Amount DECIMAL(18,2), Dimension_Set_ID BIGINT, Applies_to_Entry STRING, Batch_No STRING, "
        "Building_Code STRING, Document_Date DATE, Reversed BOOLEAN, Source_Type STRING, Source_No STRING"
    ),
    "BC_PurchaseInvoiceHeader": (
        "id STRING, no STRING, postingDate DATE, preAssignedNo STRING, userID STRING, systemModifiedAt TIMESTAMP, "
        "payToVendorNo STRING"
    ),
    "BC_SalesInvoiceHeader": (
        "`@odata.etag` STRING, id STRING, no STRING, sellToCustomerNo STRING, postingDate DATE, "
        "preAssignedNo STRING, userID STRING, systemModifiedAt TIMESTAMP"
    ),
    "BC_Customers": (
        "`@odata.etag` STRING, id STRING, number STRING, displayName STRING, type STRING, addressLine1 STRING, "
        "addressLine2 STRING, city STRING, state STRING, country STRING, postalCode STRING, phoneNumber STRING, "
        "email STRING, website STRING, salespersonCode STRING, balanceDue DECIMAL(18,2), "
        "creditLimit DECIMAL(18,2), taxLiable BOOLEAN, taxAreaId STRING, taxAreaDisplayName STRING, "
        "taxRegistrationNumber STRING, currencyId STRING, currencyCode STRING, paymentTermsId STRING, "
        "shipmentMethodId STRING, paymentMethodId STRING, blocked STRING, lastModifiedDateTime TIMESTAMP"
    ),
    "BC_Vendors": (
        "`@odata.etag` STRING, id STRING, number STRING, displayName STRING, addressLine1 STRING, "
        "addressLine2 STRING, city STRING, state STRING, country STRING, postalCode STRING, phoneNumber STRING, "
        "email STRING, website STRING, taxRegistrationNumber STRING, currencyId STRING, currencyCode STRING, "
        "irs1099Code STRING, paymentTermsId STRING, paymentMethodId STRING, taxLiable BOOLEAN, blocked STRING, "
        "balance DECIMAL(18,2), lastModifiedDateTime TIMESTAMP"
    ),
    "BC_wmsDH": _HEADER,
    "BC_wmsPDH": _HEADER,
    "BC_wmsDL": _LINE,
    "BC_wmsPDL": _LINE,
    "BC_wmsRecordLink": "id STRING, tableNo INT, created TIMESTAMP",
    "BC_GLaccounts_mapping": "Ledgernummer STRING",
}


def schema_of(target: str) -> T.StructType | None:
    """Declared columns of a target table, without the company; None if it has none here."""
    return T.StructType.fromDDL(_COLUMNS[target]) if target in _COLUMNS else None
