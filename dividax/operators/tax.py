"""Report columns (P-11 .. P-16, F-5, M-3 .. M-5).

Typed columns throughout; the original's text renderings (``"6.84 USD"``, ``-``)
are produced only by the sink projection (``plans.report.display_report``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import previous_business_day
from ..functions.money import pct_display, round_half_even, tax_due_pln, wht_amount
from ..functions.text import ticker_currency
from ..params import TaxParams
from .fx_join import FxIndex


def satisfied(rate_col: str, tax_rate: float):
    """F-5: foreign withholding already covers the flat rate (inclusive)."""
    return F.col(rate_col).isNotNull() & (F.col(rate_col) >= F.lit(float(tax_rate)))


def add_tax_columns(merged: DataFrame, fx: FxIndex, params: TaxParams | None = None) -> DataFrame:
    """Adds ``wht_pct, dividend_currency, date_d1, fx_rate_d1, wht_amount, tax_due_pln,
    fx_rate_gross, fx_missing_report`` to merged (statement, date, ticker) rows."""
    params = params or TaxParams()
    done = satisfied("wht_rate", params.tax_rate)
    staged = merged.withColumns({
        "wht_pct": pct_display("wht_rate"),                               # P-12
        "dividend_currency": ticker_currency("ticker"),                   # J-5 / P-11
        "date_d1": F.when(~done, previous_business_day("date")),          # P-13
    }).withColumn("_needs_fx", ~done & (F.col("dividend_currency") != K.BASE_CURRENCY))
    # one look-up serves the report rate (masked where no tax is due) and the full conversion of the totals
    looked = fx.lookup(staged, F.col("dividend_currency"), previous_business_day("date"), "_fx_label")
    fx_rate = F.when(F.col("_needs_fx") & (F.col("_fx_label") != 0), round_half_even("_fx_label", 4))  # P-14 / M-3
    out = looked.withColumns({
        "fx_rate_d1": fx_rate,
        "fx_rate_gross": round_half_even("_fx_label", 4),
        "fx_missing_report": F.col("_needs_fx") & F.col("_fx_label").isNull(),
        "wht_amount": wht_amount("net_dividend", "wht_rate", "wht_raw", "account_currency"),  # M-4 / P-15
    })
    out = out.withColumn(
        "tax_due_pln",
        tax_due_pln("net_dividend", "wht_rate", "wht_amount", "fx_rate_d1", "account_currency", params.tax_rate),  # M-5 / P-16
    )
    return out.drop("_needs_fx", "_fx_label")
