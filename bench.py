"""Benchmark the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``;
one warm-up, then the median of ``$BENCH_RUNS`` (default 5) runs per query, each
written to the ``noop`` sink (full evaluation, no output cost).  Prints one JSON
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from dividax.functions.text import per_share_columns, wht_rate_from_comment  # noqa: E402
from dividax.operators.dividends import filter_dividends, group_dividends, prepare_rows  # noqa: E402
from dividax.operators.fx_join import FxIndex  # noqa: E402
from dividax.plans.report import build_report_parts  # noqa: E402
from dividax.session import get_session  # noqa: E402
from dividax.sources.fx import synthetic_fx  # noqa: E402
from dividax.sources.statements import synthetic_statements  # noqa: E402


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    # one shuffle partition per core: every stage runs in a single full wave locally
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus), app="dividax-bench")

    stmt = synthetic_statements(spark, sf)
    fx_index = FxIndex(synthetic_fx(spark, sf))  # built once per job (S-12), as in production

    def parse_cascade():
        parsed = per_share_columns(stmt.select("Comment"), "Comment", "dps", "currency")
        return parsed.select("dps", "currency", wht_rate_from_comment("Comment").alias("rate"))

    def fx_lookup():
        t = stmt.select(F.col("Symbol"), F.col("Time").cast("date").alias("d"))
        from dividax.functions.dates import previous_business_day
        from dividax.functions.text import ticker_currency
        t = t.select(ticker_currency("Symbol").alias("currency"), previous_business_day("d").alias("target_date"))
        return fx_index.lookup(t, F.col("currency"), F.col("target_date"), "rate")

    jobs = {
        "filter_dividends": lambda: filter_dividends(stmt, "Type"),
        "group_dividends": lambda: group_dividends(filter_dividends(prepare_rows(stmt))),
        "parse_cascade": parse_cascade,
        "fx_lookup_d1": fx_lookup,
        "tax_due_pln": lambda: build_report_parts(stmt, fx_index).report.where(F.col("account_currency") != "USD")
        .select("acct", "date", "ticker", "net_dividend", "wht_rate", "wht_amount", "fx_rate_d1", "tax_due_pln"),
        "tax_report": lambda: build_report_parts(stmt, fx_index).report,
    }
    n_rows = stmt.count()
    results = {}
    for name, make in jobs.items():
        make().write.format("noop").mode("overwrite").save()  # warm-up
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
    rows_per_sec = {k: round(n_rows / v) for k, v in results.items() if v > 0}
    out = {
        "metric": "tax_report_median_sec",
        "value": results["tax_report"],
        "unit": "sec",
        "queries": results,
        "statement_rows": n_rows,
        "rows_per_sec": rows_per_sec,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
        "runs": runs,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
