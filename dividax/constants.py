"""Closed enumerations and fixed values of the dividend / withholding-tax domain.

FIXED VALUES — these must equal the values the original tool uses, otherwise
results differ.  They are listed plainly, in their natural order.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------

#: Flat Polish dividend tax rate (default job parameter, validated to [0, 1]).
DEFAULT_TAX_RATE = 0.19

#: Number of dates probed by the FX look-up: the target date plus 9 earlier weekdays.
FX_LOOKBACK_PROBES = 10

#: Base currency of every FX archive; its rate is always 1.0.
BASE_CURRENCY = "PLN"

#: File-name pattern of the yearly FX archives inside a data folder.
FX_ARCHIVE_PATTERN = "archiwum_tab_a_*.csv"

#: Currencies the FX archive carries, with the archive column holding each rate.
FX_ARCHIVE_COLUMNS = {"USD": "1USD", "EUR": "1EUR", "GBP": "1GBP", "DKK": "1DKK"}

#: Transaction types kept by the dividend filter (English, Polish, misspelt, WHT EN, WHT PL).
DIVIDEND_TYPES = ("Dividend", "Dywidenda", "DIVIDENT", "Withholding Tax", "Podatek od dywidend")

#: Eurozone ticker suffixes (all map to EUR).
EUROZONE_SUFFIXES = (".FR", ".DE", ".IE", ".NL", ".ES", ".IT", ".BE", ".AT", ".FI", ".PT")

#: Ticker -> dividend currency, ordered substring rules, first hit wins; default USD.
TICKER_CURRENCY_RULES = (
    (("ASB.PL",), "USD"),
    ((".US",), "USD"),
    ((".PL",), "PLN"),
    ((".DK",), "DKK"),
    ((".UK",), "GBP"),
    (EUROZONE_SUFFIXES, "EUR"),
)
TICKER_CURRENCY_DEFAULT = "USD"

#: Ticker -> default withholding-tax rate, ordered substring rules; default 0.0.
DEFAULT_WHT_RULES = (
    ("ASB.PL", 0.0),
    (".US", 0.15),
    (".PL", 0.19),
    (".DK", 0.15),
    (".UK", 0.0),
    (".IE", 0.15),
    (".FR", 0.0),
)
DEFAULT_WHT_FALLBACK = 0.0

#: Comment keyword -> canonical label (whole word, case-insensitive, first match wins).
COMMENT_KEYWORDS = (("blik", "Blik(Payu) deposit"), ("pekao", "Pekao S.A. deposit"))

#: Polish statement headers -> English statement headers.
POLISH_HEADERS = {"Czas": "Time", "Ticker": "Symbol", "Komentarz": "Comment", "Kwota": "Amount", "Typ": "Type"}

#: English statement headers -> canonical names used after normalisation.
CANONICAL_HEADERS = {"Time": "Date", "Symbol": "Ticker", "Comment": "Comment", "Amount": "Amount", "Type": "Type"}

#: Sheet that carries the cash operations, the cell that carries the account currency,
#: the header marker, the footer marker and the placeholder columns dropped at ingest.
STATEMENT_SHEET = "CASH OPERATION HISTORY"
CURRENCY_CELL = "F6"
HEADER_MARKER = "ID"
FOOTER_MARKER = "Total"
PLACEHOLDER_COLUMNS = ("Unnamed: 0", "Unnamed: 7")

#: Report display order (sink projection).
REPORT_DISPLAY_ORDER = (
    "Date", "Ticker", "Shares", "Net Dividend", "Tax Collected Amount", "Tax Collected %",
    "Date D-1", "Exchange Rate D-1", "Tax Amount PLN",
)

#: Regular expressions of the comment parsers (Java syntax, ASCII input).
RE_WHT_CURRENCY = r"([A-Z]{3})\s+WHT"
RE_PER_SHARE_LOOSE = r"([\d.]+)\s*/\s*SHR"
RE_CUR_THEN_VALUE = r"([A-Z]{3}) ([\d.]+)/ SHR"
RE_VALUE_THEN_CUR = r"([\d.]+) ([A-Z]{3})/SHR"
RE_FIRST_NUMBER = r"([\d.]+)"
RE_WHT_RATE = r"WHT\s*(\d+(?:\.\d+)?)%"
RE_ANY_RATE = r"(\d+(?:\.\d+)?)\s*%"
RE_ANSI = r"\x1B\[[0-?]*[ -/]*[@-~]"
RE_TICKER = r"^[A-Z0-9.\-]+$"

#: Security-findings severity -> report level; default "note".
SEVERITY_LEVELS = (("HIGH", "error"), ("MEDIUM", "warning"), ("LOW", "note"))
SEVERITY_NAMES = (("High", "HIGH"), ("Medium", "MEDIUM"), ("Low", "LOW"))

#: Defaults of a finding without a rule, path or text, and the version of the converted report's format.
UNKNOWN = "unknown"
DEFAULT_MESSAGE = "Security issue detected"
CONVERTED_VERSION = "2.1.0"

#: Text that counts as a number.
NUMBER_PATTERN = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
