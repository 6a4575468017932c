"""Tables, formats and thresholds the results depend on."""

# --- fixed values: transaction fragment -> company holding the settled invoice, first hit wins
TRANSACTION_COMPANIES = [
    ("VLIE", "Hartel"),
    ("HNV", "Chartering"),
    ("COA", "Chartering"),
    ("MAAS", "Geervliet"),
    ("IIVLIE", "Vliet2"),
]

# --- fixed values: transaction fragment -> company code of the payment message, first hit wins
TRANSACTION_COMPANY_CODES = [
    ("VLIE", "VLIET"),
    ("HNV", "HNV BV"),
    ("COA", "COASTA"),
    ("MAAS", "MAASVL"),
    ("IIVL", "IIVLIE"),
]

# --- fixed values: currency -> bank ledger code
CURRENCY_LEDGERS = {
    "EUR": 19200,
    "USD": 19400,
    "DKK": 19500,
    "NOK": 19600,
    "SEK": 19700,
    "GBP": 19300,
}

# --- fixed values: payment message
HOME_CURRENCY = "EUR"
AMOUNT_TOLERANCE = "0.019999"
PAY_MODE = "WT"
SALES_PREFIX = "1"
SALES_KIND = "salesInvoiceHeaders"
PURCHASE_KIND = "purchaseInvoiceHeaders"

# --- fixed values: agency -> (company, company as written in a URL)
AGENCY_COMPANIES = {
    "Maripro BV": ("Maripro", "Maripro"),
    "Maripro Belgium BV": ("Maripro Belgium", "Maripro%20Belgium"),
}

# --- fixed values: port-call document
PORTCALL_EVENT = "PortCall created"
PORTCALL_PARTNER = "KMA00038"
PORTCALL_ACTION = "INSERT"
PORTCALL_STATUS = "15-EDI"
PORTCALL_ORDER_TYPE = "AGENCIES"
PORTCALL_NAMESPACE = "www.boltrics.nl/receiveoceanfreightexport:v1.00"
PORTCALL_PREFIX = "ns0"
PORTCALL_LOOKBACK_DAYS = 7
LAST_PORT_TYPE = 1
NEXT_PORT_TYPE = 2
FIRST_REAL_DATE = "1900-01-01"

# --- fixed values: message envelope
SOAP_HEAD = (
    '<s:Envelope xmlns:s="http://schemas.xmlsoap.org/soap/envelope/"><s:Body>'
    '<PostXml xmlns="urn:microsoft-dynamics-schemas/codeunit/DIPost"><xml><![CDATA['
)
SOAP_TAIL = "\n    ]]></xml></PostXml></s:Body></s:Envelope>"

# --- fixed values: country classes
DOMESTIC_COUNTRY = "NL"
DOMESTIC_GROUP = "BINNENLAND"
EU_GROUP = "EU"
EXPORT_GROUP = "EXPORT"
UNKNOWN_GROUP = "Unknown"
EU_COUNTRIES = [
    "AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "GR", "HU", "IE",
    "IT", "LV", "LT", "LU", "MT", "NL", "PL", "PT", "RO", "SK", "SI", "ES", "SE",
]

# --- fixed values: alert pages and thresholds
JOB_QUEUE_PAGE = "&page=672"
MESSAGE_PAGE = "&page=11242113"
ALERT_THRESHOLD = 0
STUCK_MINUTES = 5

# --- fixed values: line types and link tables that are loaded
LOADED_LINE_TYPES = ["Cost", "Service"]
LINKED_TABLES = [122, 0, 112]
ATTACHMENT_TABLE = 122

# --- fixed values: voyage report kept by the settled-voyage load
VOYAGE_DATA_TYPE = "A"
VOYAGE_SNAPSHOT = "closed"
