"""Money arithmetic (M-1 .. M-6) and the rounding rule shared with the SQL oracle.

Rounding decision (made once): ``round_half_even(x, k) = rint(x * 10^k) / 10^k`` on
DOUBLE.  It equals NumPy's ``round`` used by the original when merging rows, and
the SQL oracle writes the same arithmetic as ``round_even(x * 10^k, 0) / 10^k``
so both engines agree bit for bit.  The original's Python ``round``/``format``
can differ from it by one unit in the last place on exact binary ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(x: Column | str, digits: int = 2) -> Column:
    scale = float(10 ** digits)
    return F.rint(_col(x) * F.lit(scale)) / F.lit(scale)


def exact(x: Column | str, digits: int = 8) -> Column:
    """DOUBLE -> DECIMAL of ``digits`` places (NaN and overflow -> NULL), so that sums don't depend on order."""
    return _col(x).try_cast(f"decimal({20 + digits},{digits})")


def shares_from_amount(amount: Column | str, dps: Column | str, fx: Column | str) -> Column:
    """M-1: ``round(amount / (dps * fx))`` half-even to an integer; a zero denominator -> 0."""
    denom = _col(dps) * _col(fx)
    return F.when(denom == 0, F.lit(0.0)).otherwise(F.rint(_col(amount) / denom))


def wht_amount(net: Column | str, rate: Column | str, raw: Column | str, account_currency: Column | str) -> Column:
    """M-4: withholding tax collected, in the dividend currency, 2 dp.

    * rate NULL or 0                         -> NULL (rendered ``-``)
    * USD account with a non-zero raw amount -> ``abs(raw)``
    * otherwise gross-up: ``net / (1 - rate) * rate`` (rate 1 -> NULL)
    """
    p = _col(rate)
    r = _col(raw)
    gross_up = F.try_divide(_col(net), F.lit(1.0) - p) * p
    value = F.when((_col(account_currency) == "USD") & r.isNotNull() & (r != 0), F.abs(r)).otherwise(gross_up)
    return F.when(p.isNull() | (p == 0), F.lit(None).cast("double")).otherwise(round_half_even(value, 2))


def tax_due_pln(
    net: Column | str,
    rate: Column | str,
    wht: Column | str,
    fx: Column | str,
    account_currency: Column | str,
    tax_rate: float,
) -> Column:
    """M-5: tax still due in PLN, 2 dp; NULL when the foreign rate already covers the
    flat rate, or when the rounded amount is 0.00.

    * USD account:          ``((net + wht) * tax_rate - wht) * fx``
    * every other account:  ``(net * tax_rate - wht) * fx``

    A missing WHT amount counts as 0.0, a missing FX rate (PLN) as 1.0.
    """
    p = _col(rate)
    w = F.coalesce(_col(wht), F.lit(0.0))
    x = F.coalesce(_col(fx), F.lit(1.0))
    gross = F.when(_col(account_currency) == "USD", _col(net) + w).otherwise(_col(net))
    due = round_half_even((gross * F.lit(float(tax_rate)) - w) * x, 2)
    return F.when(p.isNull() | (p >= F.lit(float(tax_rate))) | (due == 0), F.lit(None).cast("double")).otherwise(due)


def pct_display(rate: Column | str) -> Column:
    """P-12: ``-`` for NULL/0, else ``int(rate*100)%`` (truncation, as the original)."""
    p = _col(rate)
    return F.when(p.isNull() | (p == 0), F.lit("-")).otherwise(
        F.concat((p * F.lit(100.0)).cast("int").cast("string"), F.lit("%"))
    )
