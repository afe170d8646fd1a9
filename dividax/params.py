"""Job parameters (validated on the driver before any Spark job is launched)."""

from __future__ import annotations

from dataclasses import dataclass

from .constants import DEFAULT_TAX_RATE, FX_LOOKBACK_PROBES


@dataclass(frozen=True)
class TaxParams:
    """Parameters of the tax report.

    tax_rate              flat tax due on dividends (fraction in [0, 1])
    lookback_probes       dates probed by the FX look-up (target + earlier weekdays)
    convert_all_currencies  when False (default, as the original) only USD dividends on
                          PLN accounts are FX-converted when deriving share counts
    broadcast_max_rows    size bound (rows) under which the FX serving table is broadcast
    """

    tax_rate: float = DEFAULT_TAX_RATE
    lookback_probes: int = FX_LOOKBACK_PROBES
    convert_all_currencies: bool = False
    broadcast_max_rows: int = 1_000_000

    def __post_init__(self) -> None:
        if not isinstance(self.tax_rate, (int, float)) or not 0.0 <= float(self.tax_rate) <= 1.0:
            raise ValueError(f"tax_rate must be within [0, 1], got {self.tax_rate!r}")
        if int(self.lookback_probes) < 1:
            raise ValueError(f"lookback_probes must be >= 1, got {self.lookback_probes!r}")
