"""Registered queries: ``name -> (spark builder, oracle SQL)``.

Every builder takes ``(spark, sf_dir)`` and reads the given tables (or data
Spark derives from them), so its work grows with the tables.  Column names
match between a builder and its SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import dates as D
from ..functions import text as T
from ..functions.money import pct_display
from ..operators import aggregates as A
from ..operators import quality as Q
from ..operators.columns import (
    add_empty_column,
    convert_dates,
    drop_columns_strict,
    fill_missing,
    normalize_headers,
    prepare_columns,
    rename_columns_strict,
    reorder_columns,
    split_negatives,
    to_numeric,
)
from ..operators.dividends import filter_dividends, group_dividends, prepare_rows
from ..operators.fx_join import FxIndex
from ..params import TaxParams
from ..session import ensure_checkpoint_dir
from ..sources.fx import edge_fx, fx_long, synthetic_fx, synthetic_fx_wide
from ..sources.statements import damaged_statements, polish_headers, synthetic_statements, with_time_text
from . import oracle as O
from .report import build_report_parts, display_report

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _stmt(spark, sf):
    return synthetic_statements(spark, sf)


def _fx_index(spark, sf) -> FxIndex:
    """S-12: one stored FX serving table per application and data folder, shared by queries."""
    version = hashlib.sha256(f"{spark.sparkContext.applicationId} {sf}".encode()).hexdigest()[:16]
    return FxIndex.stored(synthetic_fx(spark, sf), f"{ensure_checkpoint_dir(spark).rstrip('/')}/fx-index-{version}")


def _parts(spark, sf, params: TaxParams | None = None):
    params = params or TaxParams()
    return build_report_parts(_stmt(spark, sf), _fx_index(spark, sf), params)


BASE = O.stmt_cte() + "," + O.fx_cte()
PIPE = BASE + "," + O.pipeline_ctes()


def _sql(body: str, ctes: str = BASE) -> str:
    return "WITH " + ctes.strip() + "\n" + body


# ---------------------------------------------------------------- step 1 ----

@register("filter_dividends", _sql(f"""
SELECT id, acct, account_currency, "Type" AS type, CAST("Time" AS DATE) AS date, "Symbol" AS ticker,
       "Comment" AS comment, CAST("Amount" AS DOUBLE) AS amount
FROM stmt WHERE "Type" IN {O.in_list(K.DIVIDEND_TYPES)}"""))
def q_filter_dividends(spark, sf):
    s = _stmt(spark, sf)
    return filter_dividends(s, "Type").select(
        "id", "acct", "account_currency", F.col("Type").alias("type"), F.col("Time").cast("date").alias("date"),
        F.col("Symbol").alias("ticker"), F.col("Comment").alias("comment"), F.col("Amount").cast("double").alias("amount"),
    )


@register("group_dividends", _sql("""
SELECT acct, account_currency, date, ticker, type, comment, CAST(net0 AS DOUBLE) AS net_dividend FROM _g""", PIPE))
def q_group_dividends(spark, sf):
    g = group_dividends(filter_dividends(prepare_rows(_stmt(spark, sf))))
    return g.withColumn("net_dividend", F.col("net_dividend").cast("double"))


@register("normalize_headers_pl", _sql("""
SELECT acct, CAST("Time" AS DATE) AS "Date", "Symbol" AS "Ticker", "Comment", CAST("Amount" AS DOUBLE) AS "Amount", "Type"
FROM stmt"""))
def q_normalize_headers_pl(spark, sf):
    pl = polish_headers(_stmt(spark, sf))
    df = drop_columns_strict(pl, ["id"])                      # P-3 (the statement's ID column)
    df = rename_columns_strict(df, {"account_currency": "statement_currency"})  # P-4
    df = normalize_headers(df)                                # P-1 / P-2
    return df.select("acct", F.col("Date").cast("date").alias("Date"), "Ticker", "Comment",
                     F.col("Amount").cast("double").alias("Amount"), "Type")


@register("strip_total_rows", _sql("""
SELECT id, acct, "Type" AS type, "Comment" AS comment, CAST("Amount" AS DOUBLE) AS amount FROM (
  SELECT id, acct, "Type", "Comment", "Amount" FROM stmt
  UNION ALL
  SELECT 'acct-' || CAST(acct AS VARCHAR), acct, 'Total', 'Total ' || CAST(count(*) AS VARCHAR) || ' rows', SUM("Amount")
  FROM stmt GROUP BY acct)
WHERE NOT (contains(COALESCE(id, ''), 'Total') OR contains(COALESCE("Type", ''), 'Total')
           OR contains(COALESCE("Comment", ''), 'Total') OR contains(COALESCE(CAST("Amount" AS VARCHAR), ''), 'Total'))"""))
def q_strip_total_rows(spark, sf):
    from ..sources.workbook import drop_footer_rows
    s = _stmt(spark, sf).select("id", "acct", "Type", "Comment", "Amount")
    footer = s.groupBy("acct").agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("Amount")).select(
        F.concat(F.lit("acct-"), F.col("acct").cast("string")).alias("id"), "acct", F.lit("Total").alias("Type"),
        F.concat(F.lit("Total "), F.col("n").cast("string"), F.lit(" rows")).alias("Comment"), "Amount",
    )
    kept = drop_footer_rows(s.unionByName(footer), ["id", "Type", "Comment", "Amount"])
    return kept.select("id", "acct", F.col("Type").alias("type"), F.col("Comment").alias("comment"),
                       F.col("Amount").cast("double").alias("amount"))


# ---------------------------------------------------------------- step 2 ----

@register("parse_dates", _sql(f"""
SELECT id, time_text, parsed AS date, {O.prev_bday('parsed')} AS date_d1, strftime(parsed, '%Y-%m') AS month,
       CAST(try_strptime(iso_text, '%Y-%m-%d') AS DATE) AS date_coerced
FROM (SELECT id, strftime("Time", '%d.%m.%Y %H:%M:%S') AS time_text, strftime("Time", '%Y-%m-%d') AS iso_text,
             CAST(try_strptime(strftime("Time", '%d.%m.%Y %H:%M:%S'), '%d.%m.%Y %H:%M:%S') AS DATE) AS parsed FROM stmt)"""))
def q_parse_dates(spark, sf):
    s = with_time_text(_stmt(spark, sf))
    parsed = s.select("id", "time_text", D.parse_statement_date("time_text").alias("date"),
                      D.coerce_date(F.date_format("Time", "yyyy-MM-dd")).alias("date_coerced"))   # C-2
    return parsed.withColumns({"date_d1": D.previous_business_day("date"), "month": D.month_key("date")})


@register("previous_business_day", _sql(f"""
SELECT d, {O.prev_bday('d')} AS d1, CAST(isodow(d) AS INTEGER) AS iso_weekday, {O.bidx('d')} AS bday_index
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""))
def q_previous_business_day(spark, sf):
    d = spark.read.parquet(f"{sf}/orders.parquet").select(D.to_date_only("o_orderdate").alias("d")).distinct()
    return d.select("d", D.previous_business_day("d").alias("d1"),
                    ((F.dayofweek("d") + 5) % 7 + 1).alias("iso_weekday"),
                    D.business_day_index("d").alias("bday_index"))


# ---------------------------------------------------------------- step 3 ----

@register("parse_per_share", _sql(f"""
SELECT comment, {O.per_share_dps('comment')} AS dps, {O.per_share_currency('comment')} AS currency
FROM (SELECT DISTINCT "Comment" AS comment FROM stmt)"""))
def q_parse_per_share(spark, sf):
    c = _stmt(spark, sf).select(F.col("Comment").alias("comment")).distinct()
    return T.per_share_columns(c, "comment", "dps", "currency")


@register("parse_wht_rate", _sql(f"""
SELECT comment, {O.wht_rate('comment')} AS wht_rate FROM (SELECT DISTINCT "Comment" AS comment FROM stmt)"""))
def q_parse_wht_rate(spark, sf):
    c = _stmt(spark, sf).select(F.col("Comment").alias("comment")).distinct()
    return c.select("comment", T.wht_rate_from_comment("comment").alias("wht_rate"))


@register("ticker_currency", _sql(f"""
SELECT ticker, comment, {O.ticker_currency('ticker')} AS ticker_currency,
       CASE WHEN COALESCE({O.per_share_currency('comment')}, '') <> '' THEN {O.per_share_currency('comment')}
            ELSE {O.ticker_currency('ticker')} END AS dividend_currency
FROM (SELECT DISTINCT "Symbol" AS ticker, "Comment" AS comment FROM stmt)"""))
def q_ticker_currency(spark, sf):
    c = _stmt(spark, sf).select(F.col("Symbol").alias("ticker"), F.col("Comment").alias("comment")).distinct()
    parsed = T.per_share_columns(c, "comment", "_dps", "_cur")
    return parsed.select("ticker", "comment", T.ticker_currency("ticker").alias("ticker_currency"),
                         T.dividend_currency(F.col("ticker"), F.col("_cur")).alias("dividend_currency"))


@register("default_wht", _sql(f"""
SELECT ticker, {O.default_wht('ticker')} AS default_wht FROM (SELECT DISTINCT "Symbol" AS ticker FROM stmt)"""))
def q_default_wht(spark, sf):
    t = _stmt(spark, sf).select(F.col("Symbol").alias("ticker")).distinct()
    return t.select("ticker", T.default_wht_rate("ticker").alias("default_wht"))


@register("keyword_label", _sql(f"""
SELECT comment, {O.keyword_label('comment')} AS label, count(*) AS n
FROM (SELECT "Comment" AS comment FROM stmt) GROUP BY comment"""))
def q_keyword_label(spark, sf):
    c = _stmt(spark, sf).groupBy(F.col("Comment").alias("comment")).agg(F.count(F.lit(1)).alias("n"))
    return c.select("comment", T.keyword_label("comment").alias("label"), "n")


_ANSI_CODES = (31, 32, 33, 34, 35, 36, 91)


@register("strip_ansi", _sql(f"""
SELECT id, colored, regexp_replace(colored, {O.q(K.RE_ANSI)}, '', 'g') AS ticker
FROM (SELECT id, chr(27) || '[' || CAST({O.sql_list(_ANSI_CODES)}[length(id) % 7 + 1] AS VARCHAR) || 'm' || "Symbol" || chr(27) || '[0m' AS colored
      FROM stmt)"""))
def q_strip_ansi(spark, sf):
    s = _stmt(spark, sf)
    code = F.element_at(F.array(*[F.lit(c) for c in _ANSI_CODES]), (F.length("id") % 7 + 1).cast("int"))
    colored = F.concat(F.lit("\x1b["), code.cast("string"), F.lit("m"), F.col("Symbol"), F.lit("\x1b[0m"))
    return s.select("id", colored.alias("colored")).select("id", "colored", T.strip_ansi("colored").alias("ticker"))


def _amount_text_sql():
    return """CASE WHEN "Type" = 'Deposit' THEN '-' ELSE CAST("Amount" AS VARCHAR) || ' ' || cur END"""


@register("parse_amount_text", _sql(f"""
SELECT id, txt,
       CASE WHEN ok AND regexp_matches(p1, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') THEN TRY_CAST(p1 AS DOUBLE) END AS value,
       CASE WHEN ok AND regexp_matches(p1, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') AND TRY_CAST(p1 AS DOUBLE) IS NOT NULL THEN p2 END AS currency,
       CASE WHEN trim(txt) IN ('-', 'nan') THEN 0.0 WHEN ok AND regexp_matches(p1, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') THEN TRY_CAST(p1 AS DOUBLE) END AS wht_value,
       CASE WHEN trim(txt) IN ('-', 'nan') THEN 1.0 WHEN ok AND regexp_matches(p1, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') THEN TRY_CAST(p1 AS DOUBLE) END AS fx_value
FROM (SELECT id, txt, len(parts) = 2 AND trim(txt) <> '' AND lower(trim(txt)) <> 'nan' AS ok, parts[1] AS p1, parts[2] AS p2
      FROM (SELECT id, txt, regexp_split_to_array(trim(txt), '\\s+') AS parts
            FROM (SELECT id, {_amount_text_sql()} AS txt FROM (SELECT *, {O.ticker_currency('"Symbol"')} AS cur FROM stmt))))"""))
def q_parse_amount_text(spark, sf):
    s = _stmt(spark, sf)
    txt = F.when(F.col("Type") == "Deposit", F.lit("-")).otherwise(
        F.concat(F.col("Amount").cast("string"), F.lit(" "), T.ticker_currency("Symbol")))
    t = s.select("id", txt.alias("txt"))
    p = T.parse_amount_text("txt")
    return t.select("id", "txt", p["value"].alias("value"), p["currency"].alias("currency"),
                    T.parse_wht_amount_text("txt").alias("wht_value"), T.parse_fx_text("txt").alias("fx_value"))


# ---------------------------------------------------------------- step 4 ----

def _wide_sql() -> str:
    from ..sources.fx import FX_FORMULAS
    cols = []
    for cur, base, step, span, scale in FX_FORMULAS:
        digits = len(str(scale)) - 1
        num = f"({base} + (n * {step}) % {span})"
        cols.append(f"CAST({num} // {scale} AS VARCHAR) || ',' || lpad(CAST({num} % {scale} AS VARCHAR), {digits}, '0') AS \"{K.FX_ARCHIVE_COLUMNS[cur]}\"")
    names = ", ".join(f'"{K.FX_ARCHIVE_COLUMNS[c[0]]}"' for c in FX_FORMULAS)
    descs = ", ".join(f"'1 {c[0]}'" for c in FX_FORMULAS)
    return f"""
_wr AS (SELECT 'archiwum_tab_a_' || CAST(year(rate_date) AS VARCHAR) || '.csv' AS file_name, strftime(rate_date, '%Y%m%d') AS data,
               {', '.join(cols)}, 1 + CAST(strftime(rate_date, '%Y%m%d') AS INTEGER) % 10000 AS row_no FROM _fxd),
fx_wide AS (SELECT file_name, data, {names}, row_no FROM _wr
            UNION ALL SELECT DISTINCT file_name, 'nazwa', {descs}, 0 FROM _wr)"""


def _long_sql(src: str) -> str:
    unions = " UNION ALL ".join(
        f"SELECT file_name, row_no, data, '{cur}' AS currency, \"{col}\" AS raw FROM {src}"
        for cur, col in K.FX_ARCHIVE_COLUMNS.items()
    )
    return f"""
_st AS ({unions}),
_cl AS (SELECT file_name, row_no, currency,
               CASE WHEN regexp_matches(data, '^\\d{{8}}$') THEN CAST(try_strptime(data, '%Y%m%d') AS DATE) END AS rate_date,
               CASE WHEN regexp_matches(replace(trim(raw), ',', '.'), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)$') THEN TRY_CAST(replace(trim(raw), ',', '.') AS DOUBLE) END AS rate
        FROM _st)"""


@register("fx_unpivot", _sql(f"""
SELECT file_name, currency, rate_date, rate FROM _cl WHERE rate_date IS NOT NULL AND rate IS NOT NULL""",
                             BASE + "," + _wide_sql() + "," + _long_sql("fx_wide")))
def q_fx_unpivot(spark, sf):
    from ..sources.fx import fx_clean_rows
    return fx_clean_rows(synthetic_fx_wide(spark, sf)).select(F.col("_file").alias("file_name"), "currency", "rate_date", "rate")


_SECOND_FILE_SQL = """
_w2 AS (SELECT * FROM fx_wide
        UNION ALL
        SELECT replace(file_name, '.csv', '_corr.csv'), data, "1EUR", "1USD", "1DKK", "1GBP", row_no FROM fx_wide
        WHERE row_no = 0 OR TRY_CAST(substr(data, 7, 2) AS INTEGER) % 3 = 0)"""


@register("fx_first_wins", _sql(f"""
SELECT currency, rate_date, arg_min(rate, row(file_name, row_no)) AS rate
FROM _cl WHERE rate_date IS NOT NULL AND rate IS NOT NULL GROUP BY currency, rate_date""",
                                BASE + "," + _wide_sql() + "," + _SECOND_FILE_SQL + "," + _long_sql("_w2")))
def q_fx_first_wins(spark, sf):
    wide = synthetic_fx_wide(spark, sf)
    # a correction file whose name sorts after the yearly file and whose columns are
    # permuted: its duplicates must lose against the first file
    corr = wide.where((F.col("row_no") == 0) | (F.substring("data", 7, 2).try_cast("int") % 3 == 0)).select(
        F.regexp_replace("file_name", r"\.csv$", "_corr.csv").alias("file_name"), "data",
        F.col("1EUR").alias("1USD"), F.col("1USD").alias("1EUR"), F.col("1DKK").alias("1GBP"), F.col("1GBP").alias("1DKK"),
        "row_no",
    )
    return fx_long(wide.unionByName(corr))


@register("fx_archive_scan", _sql("""
SELECT currency, rate_date, rate FROM fx"""))
def q_fx_archive_scan(spark, sf):
    from ..sources.fx import read_fx_archives, write_fx_archives
    from ..sources.report_io import scratch_path
    base = scratch_path(spark, "fx-archives")
    write_fx_archives(synthetic_fx_wide(spark, sf), base)
    return fx_long(read_fx_archives(spark, f"{base}/*/*/*.csv"))


@register("fx_archive_discovery", REGISTRY["fx_archive_scan"][1])
def q_fx_archive_discovery(spark, sf):
    """S-7: a data folder with an archive per year, and a CSV before them whose (wrong) rates would win."""
    from ..sources.fx import archive_glob, read_fx_archives
    from ..sources.report_io import scratch_path
    base = scratch_path(spark, "fx-folder")
    wide = synthetic_fx_wide(spark, sf)
    rates = [F.col(f"`{c}`") for c in K.FX_ARCHIVE_COLUMNS.values()]
    csv = {"sep": ";", "header": True}
    name = F.concat(F.substring("file_name", 16, 4), F.lit(".csv")).alias("archiwum_tab_a_year")  # folders archiwum_tab_a_year=<year>.csv
    wide.select(name, "data", *rates).write.partitionBy("archiwum_tab_a_year").options(**csv).csv(base)
    wide.select("data", *[F.lit("99,0").alias(c) for c in K.FX_ARCHIVE_COLUMNS.values()]).write.options(**csv).csv(f"{base}/a_kursy.csv")
    return fx_long(read_fx_archives(spark, archive_glob(base)))


_TARGET_CURRENCIES = ("USD", "EUR", "GBP", "DKK", "PLN", "SEK")
_TARGETS_SQL = f"""
_tg AS (SELECT unnest({O.sql_list(_TARGET_CURRENCIES)}) AS currency, target_date
        FROM (SELECT DISTINCT {O.prev_bday('CAST("Time" AS DATE)')} AS target_date FROM stmt))"""


def _targets(spark, sf):
    s = _stmt(spark, sf).select(D.previous_business_day(F.col("Time").cast("date")).alias("target_date")).distinct()
    return s.select(F.explode(F.array(*[F.lit(c) for c in _TARGET_CURRENCIES])).alias("currency"), "target_date")


@register("fx_lookup_d1", _sql(f"""
SELECT currency, target_date, rate FROM _lk""",
                               BASE + "," + _TARGETS_SQL + "," + O.fx_lookup_ctes("_tg", "currency", "target_date", "rate", "_lk")))
def q_fx_lookup_d1(spark, sf):
    idx = _fx_index(spark, sf)
    return idx.lookup(_targets(spark, sf), F.col("currency"), F.col("target_date"), "rate")


@register("fx_missing", _sql(f"""
SELECT currency, target_date,
       CASE WHEN currency NOT IN ('PLN', 'USD', 'EUR', 'GBP', 'DKK') THEN 'unsupported' ELSE 'no_rate' END AS reason
FROM _lk WHERE rate IS NULL""",
                             BASE + "," + _TARGETS_SQL + "," + O.fx_lookup_ctes("_tg", "currency", "target_date", "rate", "_lk")))
def q_fx_missing(spark, sf):
    idx = _fx_index(spark, sf)
    return Q.fx_violations(idx.lookup(_targets(spark, sf), F.col("currency"), F.col("target_date"), "rate"))


# ---------------------------------------------------------------- step 5 ----

@register("shares_and_net", _sql("""
SELECT acct, account_currency, date, ticker, type, comment, dps, dividend_cur, shares, net2 AS net_dividend,
       CAST(wht_raw AS DOUBLE) AS wht_raw, fx_missing_sh AS fx_missing_shares FROM _rows2""", PIPE))
def q_shares_and_net(spark, sf):
    r = _parts(spark, sf).rows
    return r.select("acct", "account_currency", "date", "ticker", "type", "comment", "dps", "dividend_cur", "shares",
                    "net_dividend", F.col("wht_raw").cast("double").alias("wht_raw"), "fx_missing_shares")


@register("split_negatives", _sql("""
SELECT acct, date, ticker, type, comment, net1 AS net_dividend, CAST(wht_raw AS DOUBLE) AS tax_collected FROM _s""", PIPE))
def q_split_negatives(spark, sf):
    g = group_dividends(filter_dividends(prepare_rows(_stmt(spark, sf))))
    g = g.withColumn("net_dividend", F.col("net_dividend").cast("double"))
    s = split_negatives(g, "net_dividend", "tax_collected")
    return s.select("acct", "date", "ticker", "type", "comment", "net_dividend", "tax_collected")


@register("zero_denominator", _sql("""
SELECT acct, CAST(count_if(zero_den) AS BIGINT) AS zero_denominator_rows,
       COALESCE(array_to_string(list_transform(list_sort(list({'d': date, 't': ticker, 'ty': type, 'c': comment, 'd1': date_d1}) FILTER (WHERE zero_den))[1:3], lambda x: x.t || ' on ' || strftime(x.d1, '%Y-%m-%d')), ', '), '') AS samples
FROM _rows2 GROUP BY acct""", PIPE))
def q_zero_denominator(spark, sf):
    return A.zero_denominator_report(_parts(spark, sf).rows)


# ---------------------------------------------------------------- step 6 ----

@register("wht_rate_per_group", _sql("""
SELECT acct, account_currency, date, ticker, wht_rate, rate_source FROM _mm""", PIPE))
def q_wht_rate_per_group(spark, sf):
    return _parts(spark, sf).merged.select("acct", "account_currency", "date", "ticker", "wht_rate", "rate_source")


@register("merge_rows", _sql("""
SELECT acct, account_currency, date, ticker, net_dividend, wht_rate, wht_raw, shares FROM _mm""", PIPE))
def q_merge_rows(spark, sf):
    return _parts(spark, sf).merged.select("acct", "account_currency", "date", "ticker", "net_dividend", "wht_rate", "wht_raw", "shares")


@register("default_rate_fallbacks", _sql("""
SELECT acct, count(*) AS groups,
       array_to_string(list_transform(list_sort(list({'d': date, 't': ticker, 'r': wht_rate}))[1:3], lambda x: x.t || ' on ' || strftime(x.d, '%Y-%m-%d') || ' (' || CAST(CAST(round(x.r * 100) AS INTEGER) AS VARCHAR) || '%)'), ', ') AS samples
FROM _mm WHERE rate_source = 'default' AND wht_rate <> 0 GROUP BY acct""", PIPE))
def q_default_rate_fallbacks(spark, sf):
    return A.default_rate_fallbacks(_parts(spark, sf).merged)


@register("zero_rate_tickers", _sql("""
SELECT acct, ticker, count(*) AS groups
FROM _mm WHERE rate_source = 'default' AND wht_rate = 0 GROUP BY acct, ticker""", PIPE))
def q_zero_rate_tickers(spark, sf):
    return A.zero_rate_tickers(_parts(spark, sf).merged)


# ---------------------------------------------------------------- step 7 ----

@register("wht_amount", _sql("""
SELECT acct, account_currency, date, ticker, net_dividend, wht_rate, wht_amount, dividend_currency FROM rep_all""", PIPE))
def q_wht_amount(spark, sf):
    return _parts(spark, sf).merged.select("acct", "account_currency", "date", "ticker", "net_dividend", "wht_rate",
                                           "wht_amount", "dividend_currency")


@register("tax_due_pln", _sql("""
SELECT acct, date, ticker, net_dividend, wht_rate, wht_amount, fx_rate_d1, tax_due_pln FROM rep WHERE account_currency <> 'USD'""", PIPE))
def q_tax_due_pln(spark, sf):
    r = _parts(spark, sf).report
    return r.where(F.col("account_currency") != "USD").select("acct", "date", "ticker", "net_dividend", "wht_rate",
                                                             "wht_amount", "fx_rate_d1", "tax_due_pln")


@register("tax_due_usd", _sql("""
SELECT acct, date, ticker, net_dividend, wht_rate, wht_amount, fx_rate_d1, tax_due_pln FROM rep WHERE account_currency = 'USD'""", PIPE))
def q_tax_due_usd(spark, sf):
    r = _parts(spark, sf).report
    return r.where(F.col("account_currency") == "USD").select("acct", "date", "ticker", "net_dividend", "wht_rate",
                                                             "wht_amount", "fx_rate_d1", "tax_due_pln")


@register("pct_display", _sql(f"""
SELECT wht_rate, {O.pct_display('wht_rate')} AS wht_pct, count(*) AS n FROM _mm GROUP BY wht_rate""", PIPE))
def q_pct_display(spark, sf):
    m = _parts(spark, sf).merged
    return m.groupBy("wht_rate").agg(F.count(F.lit(1)).alias("n")).select("wht_rate", pct_display("wht_rate").alias("wht_pct"), "n")


@register("tax_report", _sql("SELECT * FROM rep", PIPE))
def q_tax_report(spark, sf):
    return _parts(spark, sf).report


# ---------------------------------------------------------------- step 8 ----

_GROSS = "CAST(net_dividend AS DECIMAL(18,2)) * CAST({} AS DECIMAL(18,4))"


@register("tax_totals", _sql(f"""
SELECT acct, total_tax_pln, gross_pln_reported, gross_pln_converted, {O.r2('gross_pln_reported - total_tax_pln')} AS net_after_tax_pln,
       report_rows, unconverted_rows, quarantined_rows
FROM (SELECT acct, {O.total('CASE WHEN NOT quarantined THEN CAST(tax_due_pln AS DECIMAL(18,2)) END')} AS total_tax_pln,
             {O.total(f"CASE WHEN NOT quarantined THEN {_GROSS.format('COALESCE(fx_rate_d1, 1.0)')} END")} AS gross_pln_reported,
             {O.total(f"CASE WHEN NOT quarantined THEN {_GROSS.format('fx_rate_gross')} END")} AS gross_pln_converted,
             CAST(count_if(NOT quarantined) AS BIGINT) AS report_rows,
             CAST(count_if(NOT quarantined AND fx_rate_gross IS NULL) AS BIGINT) AS unconverted_rows,
             CAST(count_if(quarantined) AS BIGINT) AS quarantined_rows
      FROM rep_all GROUP BY acct)""", PIPE))
def q_tax_totals(spark, sf):
    return A.tax_totals(_parts(spark, sf).scored)


@register("tax_by_month", _sql(f"""
SELECT acct, month, {O.total('CASE WHEN NOT quarantined THEN CAST(tax_due_pln AS DECIMAL(18,2)) END')} AS total_tax_pln,
       CAST(count_if(NOT quarantined) AS BIGINT) AS report_rows, CAST(count_if(quarantined) AS BIGINT) AS quarantined_rows
FROM (SELECT acct, strftime(date, '%Y-%m') AS month, tax_due_pln, quarantined FROM rep_all)
GROUP BY ROLLUP (acct, month)""", PIPE))
def q_tax_by_month(spark, sf):
    return A.tax_by_month(_parts(spark, sf).scored)


@register("net_by_ticker", _sql("""
SELECT ticker, round_even(CAST(SUM(CAST(v AS DECIMAL(22,2))) AS DOUBLE) * 100, 0) / 100 AS total_net_dividend, arg_min(sym, row(date, acct)) AS currency_symbol, count(*) AS n
FROM (SELECT ticker, date, acct,
             CASE WHEN contains(txt, 'PLN') THEN 'PLN' WHEN contains(txt, 'USD') THEN '$' ELSE '' END AS sym,
             CASE WHEN regexp_matches(regexp_replace(txt, '[^0-9.]', '', 'g'), '^[0-9]*\\.?[0-9]*$') AND regexp_matches(regexp_replace(txt, '[^0-9.]', '', 'g'), '[0-9]')
                  THEN TRY_CAST(regexp_replace(txt, '[^0-9.]', '', 'g') AS DOUBLE) END AS v
      FROM (SELECT ticker, date, acct, regexp_replace(CAST(CAST(net_dividend AS DECIMAL(38,2)) AS VARCHAR), '0$', '') || ' ' || dividend_currency AS txt FROM rep))
GROUP BY ticker""", PIPE))
def q_net_by_ticker(spark, sf):
    shown = display_report(_parts(spark, sf).report)
    return A.net_by_ticker(shown)


@register("ticker_symbol", _sql("""
SELECT ticker, arg_min(sym, row(date, acct)) AS currency_symbol, min(date) AS first_seen
FROM (SELECT ticker, date, acct, CASE WHEN dividend_currency = 'PLN' THEN 'PLN' WHEN dividend_currency = 'USD' THEN '$' ELSE '' END AS sym FROM rep)
GROUP BY ticker""", PIPE))
def q_ticker_symbol(spark, sf):
    return A.ticker_symbols(_parts(spark, sf).report)


# ---------------------------------------------------------------- step 9 ----

@register("dq_contracts", _sql(f"""
SELECT 'input' AS contract, rule, CAST(violations AS BIGINT) AS violations FROM (
  SELECT count_if(id IS NULL) AS null_id, count_if("Type" IS NULL) AS null_type,
         count_if("Type" IN {O.in_list(K.DIVIDEND_TYPES)} AND NOT regexp_matches(COALESCE("Symbol", ''), {O.q(K.RE_TICKER)})) AS bad_ticker,
         count_if("Type" IN {O.in_list(K.DIVIDEND_TYPES)} AND "Comment" IS NULL) AS null_comment
  FROM stmt) UNPIVOT (violations FOR rule IN (null_id, null_type, bad_ticker, null_comment))
UNION ALL
SELECT 'output', rule, CAST(violations AS BIGINT) FROM (
  SELECT count_if(date IS NULL) AS null_date, count_if(net_dividend IS NULL) AS null_net,
         count_if(NOT regexp_matches(COALESCE(ticker, ''), {O.q(K.RE_TICKER)})) AS bad_ticker,
         count_if(shares IS NULL) AS null_shares, count_if(shares < 0) AS negative_shares
  FROM rep) UNPIVOT (violations FOR rule IN (null_date, null_net, bad_ticker, null_shares, negative_shares))""", PIPE))
def q_dq_contracts(spark, sf):
    p = _parts(spark, sf)
    return Q.input_contract(_stmt(spark, sf)).unionByName(Q.output_contract(p.report))


@register("duplicate_ids", _sql("""
SELECT id, count(*) AS n FROM stmt GROUP BY id HAVING count(*) > 1"""))
def q_duplicate_ids(spark, sf):
    return Q.duplicate_ids(_stmt(spark, sf), "id")


@register("wht_anomalies", _sql("""
SELECT acct, date, ticker, wht_rate, rate_source FROM _mm WHERE wht_rate IS NULL OR wht_rate = 0""", PIPE))
def q_wht_anomalies(spark, sf):
    return Q.wht_anomalies(_parts(spark, sf).merged)


@register("us_30pct", _sql("""
SELECT acct, count(*) AS groups, array_to_string(list_transform(list_sort(list({'d': date, 't': ticker}))[1:3], lambda x: x.t), ', ') AS examples
FROM _mm WHERE contains(ticker, 'US') AND abs(wht_rate - 0.30) < 0.01 GROUP BY acct""", PIPE))
def q_us_30pct(spark, sf):
    return Q.us_30pct(_parts(spark, sf).merged)


# --------------------------------------------------------------- step 10 ----

@register("export_roundtrip", _sql("""
SELECT CAST(acct AS VARCHAR) AS acct, strftime(date, '%Y-%m-%d') AS "Date", ticker AS "Ticker", round_even(shares * 100.0, 0) / 100.0 AS "Shares",
       regexp_replace(CAST(CAST(net_dividend AS DECIMAL(38,2)) AS VARCHAR), '0$', '') || ' ' || dividend_currency AS "Net Dividend",
       COALESCE(CAST(CAST(wht_amount AS DECIMAL(18,2)) AS VARCHAR) || ' ' || dividend_currency, '-') AS "Tax Collected Amount",
       wht_pct AS "Tax Collected %",
       COALESCE(strftime(date_d1, '%Y-%m-%d'), '-') AS "Date D-1",
       COALESCE(CAST(CAST(fx_rate_d1 AS DECIMAL(18,4)) AS VARCHAR) || ' PLN', '-') AS "Exchange Rate D-1",
       COALESCE(CAST(CAST(tax_due_pln AS DECIMAL(18,2)) AS VARCHAR) || ' PLN', '-') AS "Tax Amount PLN"
FROM rep""", PIPE))
def q_export_roundtrip(spark, sf):
    from ..sources.report_io import report_roundtrip
    return report_roundtrip(spark, display_report(_parts(spark, sf).report))


@register("workbook_ingest", _sql("""
SELECT id AS "ID", "Type", strftime("Time", '%d.%m.%Y %H:%M:%S') AS "Time", "Comment", "Symbol",
       CAST("Amount" AS VARCHAR) AS "Amount", account_currency
FROM stmt"""))
def q_workbook_ingest(spark, sf):
    from ..sources.workbook import cells_to_statements, decode_cells, statement_workbooks
    rows, _bad = cells_to_statements(decode_cells(statement_workbooks(_stmt(spark, sf))))
    return rows.select("ID", "Type", "Time", "Comment", "Symbol", "Amount", "account_currency")


def _fleet(spark, sf, mixed=False):
    """Typed workbooks of all statement rows, written to the shared folder and read as files: (statements, rejects)."""
    from ..sources.report_io import scratch_path
    from ..sources.workbook import cells_to_statements, read_workbook_cells, write_statement_fleet
    folder = scratch_path(spark, "fleet")
    write_statement_fleet(_stmt(spark, sf), folder, mixed).write.parquet(f"{folder}/written")
    return cells_to_statements(read_workbook_cells(spark, folder))


_REJECTED = """_first AS (SELECT acct, min(year("Time")) AS year FROM stmt WHERE acct < 3 GROUP BY acct)"""


@register("workbook_fleet", _sql("""
SELECT id AS "ID", "Type", strftime("Time", '%Y-%m-%d %H:%M:%S') AS "Time", CAST("Time" AS DATE) AS date, "Comment", "Symbol",
       "Amount" AS amount, account_currency, acct, year("Time") AS year
FROM stmt ANTI JOIN _first ON stmt.acct = _first.acct AND year("Time") = _first.year""", BASE + "," + _REJECTED))
def q_workbook_fleet(spark, sf):
    """S-1..S-5 through files: date and number cells, damaged files left out."""
    from ..sources.workbook import fleet_file
    rows, _bad = _fleet(spark, sf)
    return rows.select("ID", "Type", "Time", D.coerce_date("Time").alias("date"), "Comment", "Symbol", F.col("Amount").cast("decimal(18,6)").alias("amount"),
                       "account_currency", *fleet_file("acct"))


@register("workbook_rejects", _sql("""
SELECT acct, year, ['corrupt', 'no_currency', 'header_twice'][acct + 1] AS reason FROM _first""", BASE + "," + _REJECTED))
def q_workbook_rejects(spark, sf):
    """S-2, S-6: the damaged files, each with the reason that the reader gives, as one row per account and year."""
    from ..sources.workbook import fleet_file, reject_reason
    _rows, bad = _fleet(spark, sf)
    return bad.select(*fleet_file("path"), reject_reason("_error").alias("reason")).distinct()


@register("workbook_mixed", _sql("""
SELECT id AS "ID", "Type", CAST("Time" AS DATE) AS date, "Comment", "Symbol", "Amount" AS amount, account_currency, acct, year("Time") AS year
FROM stmt ANTI JOIN _first ON stmt.acct = _first.acct AND year("Time") = _first.year
WHERE year("Time") % 4 <> 3""", BASE + "," + _REJECTED))
def q_workbook_mixed(spark, sf):
    """P-1, P-2, U-1: English, Polish and reordered files in one scan; files without amounts are left out."""
    from ..sources.workbook import fleet_file
    rows, _bad = _fleet(spark, sf, mixed=True)
    return rows.select("ID", "Type", D.coerce_date("Time").alias("date"), "Comment", "Symbol", F.col("Amount").cast("decimal(18,6)").alias("amount"),
                       "account_currency", *fleet_file("acct"))


@register("workbook_mixed_rejects", _sql("""
SELECT DISTINCT s.acct, year(s."Time") AS year,
       COALESCE(['corrupt', 'no_currency', 'header_twice'][f.acct + 1], 'column_missing') AS reason
FROM stmt s LEFT JOIN _first f ON s.acct = f.acct AND year(s."Time") = f.year
WHERE f.acct IS NOT NULL OR year(s."Time") % 4 = 3""", BASE + "," + _REJECTED))
def q_workbook_mixed_rejects(spark, sf):
    """P-1: files that lack a statement column in both languages are rejected beside the damaged ones."""
    from ..sources.workbook import fleet_file, reject_reason
    _rows, bad = _fleet(spark, sf, mixed=True)
    return bad.select(*fleet_file("path"), reject_reason("_error").alias("reason")).distinct()


@register("workbook_report", _sql("""
SELECT acct, account_currency, date, ticker, CAST(net0 AS DOUBLE) AS net_dividend, type, comment
FROM _g ANTI JOIN _first ON _g.acct = _first.acct AND year(date) = _first.year""", PIPE + "," + _REJECTED))
def q_workbook_report(spark, sf):
    """A-1 over the files' typed cells."""
    from ..sources.workbook import fleet_file
    rows, _bad = _fleet(spark, sf)
    g = group_dividends(filter_dividends(prepare_rows(rows))).withColumnRenamed("acct", "path")
    acct, _year = fleet_file("path")
    # a year's files may be several, each a statement of its own
    return g.groupBy(acct, "account_currency", "date", "ticker", "type", "comment").agg(F.sum("net_dividend").cast("double").alias("net_dividend"))


# --------------------------------------------------------------- step 11 ----

@register("latest_archives", _sql(r"""
SELECT year, label FROM (
  SELECT CAST(regexp_extract(label, '(\d{4})', 1) AS INTEGER) AS year, min(label) AS label
  FROM (SELECT 'archiwum_tab_a_' || CAST(y AS VARCHAR) || '.csv' AS label FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
        UNION ALL
        SELECT 'kursy_' || CAST(y AS VARCHAR) || '_tabela_a.csv' FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders))
  GROUP BY 1)
ORDER BY year DESC LIMIT 3"""))
def q_latest_archives(spark, sf):
    from ..sources.archives import archive_labels, latest_archives
    return latest_archives(archive_labels(spark, sf), keep=3)


_EV_SQL = r"""
_ev AS (SELECT event_id, event_type, user_id, value,
               event_type || '-' || CAST(event_id // 1000 AS VARCHAR) AS report_id,
               CAST(floor(value) AS BIGINT) AS whole,
               CASE WHEN value >= 30 THEN 'HIGH' WHEN value >= 10 THEN 'MEDIUM' WHEN value >= 2 THEN 'LOW' END AS sev,
               CASE WHEN event_type = 'error' AND user_id % 5 = 0 THEN NULL ELSE 'B' || CAST(user_id % 12 + 100 AS VARCHAR) END AS test_id,
               'src\pkg' || CAST(user_id % 7 AS VARCHAR) || '\mod' || CAST(event_id % 3 AS VARCHAR) || '.py' AS filename,
               CASE WHEN value >= 1 THEN event_id % 400 + 1 END AS line_number,
               CASE WHEN event_type <> 'view' THEN event_type || ' at ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS issue_text
        FROM events)"""


def _findings(spark, sf):
    from ..sources.findings import findings_from_events, read_findings, write_findings
    from ..sources.report_io import scratch_path
    path = write_findings(findings_from_events(spark, sf), scratch_path(spark, "findings"))  # S-17
    return read_findings(spark, path, multiline=False)                                      # S-16


@register("findings_flat", _sql(r"""
SELECT report_id, CAST(rn - 1 AS INTEGER) AS result_index, COALESCE(test_id, 'unknown') AS rule_id,
       COALESCE(issue_text, 'Security issue detected') AS message, replace(filename, '\', '/') AS uri,
       COALESCE(line_number, 1) AS start_line, 1 AS start_column,
       CASE COALESCE(sev, 'LOW') WHEN 'HIGH' THEN 'error' WHEN 'MEDIUM' THEN 'warning' ELSE 'note' END AS level,
       replace(filename, '\', '/') || ':' || CAST(COALESCE(line_number, 1) AS VARCHAR) AS fingerprint
FROM (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY event_id) AS rn FROM _ev)""", _EV_SQL))
def q_findings_flat(spark, sf):
    from ..operators.findings import flatten_findings
    return flatten_findings(_findings(spark, sf))


def _large_findings(spark, sf):
    from ..sources.findings import findings_from_events, read_large_findings, write_documents
    from ..sources.report_io import scratch_path
    path = write_documents(findings_from_events(spark, sf), scratch_path(spark, "documents"))
    return read_large_findings(spark, path, scratch_path(spark, "cut"))


@register("findings_flat_documents", REGISTRY["findings_flat"][1])
def q_findings_flat_documents(spark, sf):
    """S-16 over indented documents that are cut into results line by line."""
    from ..operators.findings import flatten_results
    return flatten_results(_large_findings(spark, sf)[1])


@register("finding_counts", _sql("""
SELECT report_id, 'ok' AS status, CAST(count(*) * 25 + sum(whole) AS BIGINT) AS lines_scanned, CAST(count(*) AS INTEGER) AS total_issues,
       CAST(count_if(sev = 'HIGH') AS BIGINT) AS high,
       CAST(CASE WHEN any_value(event_type) <> 'click' THEN count_if(sev = 'MEDIUM') ELSE 0 END AS BIGINT) AS medium,
       CAST(count_if(sev = 'LOW') AS BIGINT) AS low
FROM _ev GROUP BY report_id""", _EV_SQL))
def q_finding_counts(spark, sf):
    from ..operators.findings import finding_counts
    return finding_counts(_findings(spark, sf))


@register("finding_counts_documents", REGISTRY["finding_counts"][1])
def q_finding_counts_documents(spark, sf):
    from ..operators.findings import finding_counts
    return finding_counts(_large_findings(spark, sf)[0])


@register("top_rules", _sql("""
SELECT report_id, CAST(rk AS INTEGER) AS rank, rule_id, n FROM (
  SELECT report_id, rule_id, n, row_number() OVER (PARTITION BY report_id ORDER BY n DESC, rule_id) AS rk
  FROM (SELECT report_id, COALESCE(test_id, 'unknown') AS rule_id, count(*) AS n FROM _ev GROUP BY report_id, rule_id))
WHERE rk <= 3""", _EV_SQL))
def q_top_rules(spark, sf):
    from ..operators.findings import top_rules
    return top_rules(_findings(spark, sf), 3)


@register("findings_export", REGISTRY["findings_flat"][1])
def q_findings_export(spark, sf):
    from ..operators.findings import converted_findings, flatten_converted
    from ..sources.findings import read_converted, write_converted
    from ..sources.report_io import scratch_path
    path = write_converted(converted_findings(_findings(spark, sf)), scratch_path(spark, "converted"))
    return flatten_converted(read_converted(spark, path))


@register("finding_status", _sql("""
SELECT 'ok' AS status, count(DISTINCT report_id) AS reports, CAST(count(*) AS BIGINT) AS total_issues FROM _ev
UNION ALL SELECT 'unreadable', count(DISTINCT user_id), NULL FROM _ev""", _EV_SQL))
def q_finding_status(spark, sf):
    """Whole reports, and one cut-off report per user beside them."""
    from ..operators.findings import finding_counts
    from ..sources.findings import findings_from_events, read_findings, write_findings
    from ..sources.report_io import scratch_path
    path = write_findings(findings_from_events(spark, sf), scratch_path(spark, "findings"))
    users = spark.read.parquet(f"{sf}/events.parquet").select("user_id").distinct()
    users.select(F.concat(F.lit('{"report_id": "u'), F.col("user_id").cast("string"), F.lit('", "results": [{')).alias("value")).write.mode("append").text(path)
    counts = finding_counts(read_findings(spark, path, multiline=False))
    return counts.groupBy("status").agg(F.count(F.lit(1)).alias("reports"), F.sum("total_issues").alias("total_issues"))


# ------------------------------------- statements with damage, odd rates ----

DAMAGED = O.damaged_cte() + "," + O.fx_cte() + "," + O.pipeline_ctes()
EDGE = O.stmt_cte() + "," + O.fx_cte(edge=True)
EDGE_PIPE = EDGE + "," + O.pipeline_ctes()


def _damaged(spark, sf):
    return damaged_statements(_stmt(spark, sf))


def _damaged_parts(spark, sf):
    return build_report_parts(_damaged(spark, sf), _fx_index(spark, sf))


def _edge_parts(spark, sf):
    return build_report_parts(_stmt(spark, sf), FxIndex(edge_fx(spark, sf)))


@register("report_quarantine", _sql("""
SELECT acct, account_currency, date, ticker, CASE WHEN fx_missing_shares THEN 'shares' ELSE 'report' END AS stage, dividend_currency, date_d1
FROM rep_all WHERE quarantined""", PIPE))
def q_report_quarantine(spark, sf):
    return _parts(spark, sf).quarantine


@register("dropped_rows", _sql(f"""
SELECT acct, account_currency, date, ticker, type, comment, CAST(amount AS DOUBLE) AS amount,
       concat_ws(',', CASE WHEN date IS NULL THEN 'date' END, CASE WHEN ticker IS NULL THEN 'ticker' END, CASE WHEN comment IS NULL THEN 'comment' END) AS missing
FROM _rows WHERE type IN {O.in_list(K.DIVIDEND_TYPES)} AND (date IS NULL OR ticker IS NULL OR comment IS NULL)""", DAMAGED))
def q_dropped_rows(spark, sf):
    return _damaged_parts(spark, sf).dropped.withColumn("amount", F.col("amount").cast("double"))


@register("tax_report_damaged", _sql("SELECT * FROM rep", DAMAGED))
def q_tax_report_damaged(spark, sf):
    return _damaged_parts(spark, sf).report


@register("no_per_share", _sql("""
SELECT acct, date, ticker, type, comment, net1 AS net_dividend FROM _rows2 WHERE net1 IS NOT NULL AND NOT COALESCE(dps > 0, false)""", DAMAGED))
def q_no_per_share(spark, sf):
    return Q.no_per_share(_damaged_parts(spark, sf).rows)


@register("negative_tax", _sql("""
SELECT acct, date, ticker, wht_rate, tax_due_pln FROM rep WHERE tax_due_pln < 0""", PIPE))
def q_negative_tax(spark, sf):
    return Q.negative_tax(_parts(spark, sf).report)


@register("dq_contracts_damaged", REGISTRY["dq_contracts"][1].replace(PIPE.strip(), DAMAGED.strip()))
def q_dq_contracts_damaged(spark, sf):
    return Q.input_contract(_damaged(spark, sf)).unionByName(Q.output_contract(_damaged_parts(spark, sf).report))


@register("parse_per_share_forms", _sql(f"""
SELECT comment, {O.per_share_dps('comment')} AS dps, {O.per_share_currency('comment')} AS currency, {O.wht_rate('comment')} AS wht_rate,
       {O.keyword_label('comment')} AS label
FROM (SELECT DISTINCT "Comment" AS comment FROM stmt)""", DAMAGED))
def q_parse_per_share_forms(spark, sf):
    c = _damaged(spark, sf).select(F.col("Comment").alias("comment")).distinct()
    return T.per_share_columns(c, "comment", "dps", "currency").withColumns(
        {"wht_rate": T.wht_rate_from_comment("comment"), "label": T.keyword_label("comment")})


@register("column_layout", _sql("""
SELECT COALESCE("Symbol", '0') AS "Ticker", "Time" AS "Date", 0.0 AS "Tax Collected", 0.0 AS "Net Dividend", COALESCE("Comment", '0') AS "Comment"
FROM stmt""", DAMAGED))
def q_column_layout(spark, sf):
    """P-5, P-6, P-9, P-18."""
    df = add_empty_column(normalize_headers(_damaged(spark, sf)), "Tax Collected", 4)
    return reorder_columns(fill_missing(prepare_columns(df)), ("Ticker", "Date", "Tax Collected", "Net Dividend", "Comment"))


@register("convert_dates", _sql("""
SELECT acct, CAST(CASE WHEN acct IN (0, 1) THEN "Time" END AS DATE) AS "Data", count(*) AS n FROM stmt GROUP BY ALL"""))
def q_convert_dates(spark, sf):
    """C-2: the account decides how its dates are written; two of the ways are no dates."""
    t, acct = F.col("Time"), F.col("acct")
    text = F.when(acct == 0, F.date_format(t, "dd.MM.yyyy HH:mm:ss")).when(acct == 1, F.date_format(t, "yyyy-MM-dd")).when(acct == 2, F.date_format(t, "dd/MM")).otherwise("")
    return convert_dates(_stmt(spark, sf).select("acct", text.alias("Data"))).groupBy("acct", "Data").agg(F.count(F.lit(1)).alias("n"))


_NUMBER_FORMS = ("nan", "inf", "1d", "1.2.3", "", " 12.5 ", "-3", "1e3", ".5", "x")


@register("numeric_coercion", _sql(f"""
SELECT raw, CASE trim(raw) WHEN '12.5' THEN 12.5 WHEN '-3' THEN -3.0 WHEN '1e3' THEN 1000.0 WHEN '.5' THEN 0.5 END AS value, count(*) AS n
FROM (SELECT {O.sql_list(_NUMBER_FORMS)}[l_orderkey % 10 + 1] AS raw FROM lineitem) GROUP BY ALL""", "_one AS (SELECT 1)"))
def q_numeric_coercion(spark, sf):
    form = F.element_at(F.array(*[F.lit(x) for x in _NUMBER_FORMS]), (F.col("l_orderkey") % 10 + 1).cast("int"))
    raw = spark.read.parquet(f"{sf}/lineitem.parquet").select(form.alias("raw"))
    return to_numeric(raw.withColumn("value", F.col("raw")), ["value"]).groupBy("raw", "value").agg(F.count(F.lit(1)).alias("n"))


@register("shares_all_currencies", _sql("""
SELECT acct, date, ticker, type, comment, shares, net2 AS net_dividend, fx_missing_sh AS fx_missing_shares FROM _rows2""",
                                        BASE + "," + O.pipeline_ctes(convert_all=True)))
def q_shares_all_currencies(spark, sf):
    r = build_report_parts(_stmt(spark, sf), _fx_index(spark, sf), TaxParams(convert_all_currencies=True)).rows
    return r.select("acct", "date", "ticker", "type", "comment", "shares", "net_dividend", "fx_missing_shares")


_ANY_DAY_SQL = f"""
_tg AS (SELECT unnest({O.sql_list(_TARGET_CURRENCIES)}) AS currency, target_date FROM (SELECT DISTINCT CAST("Time" AS DATE) AS target_date FROM stmt))"""


@register("fx_lookup_any_day", _sql("""
SELECT currency, target_date, rate FROM _lk""",
                                    EDGE + "," + _ANY_DAY_SQL + "," + O.fx_lookup_ctes("_tg", "currency", "target_date", "rate", "_lk")))
def q_fx_lookup_any_day(spark, sf):
    """J-1 with weekend targets, weekend-dated rates and zero rates."""
    days = _stmt(spark, sf).select(F.col("Time").cast("date").alias("target_date")).distinct()
    targets = days.select(F.explode(F.array(*[F.lit(c) for c in _TARGET_CURRENCIES])).alias("currency"), "target_date")
    return FxIndex(edge_fx(spark, sf)).lookup(targets, F.col("currency"), F.col("target_date"), "rate")


@register("zero_denominator_zero_rate", REGISTRY["zero_denominator"][1].replace(PIPE.strip(), EDGE_PIPE.strip()))
def q_zero_denominator_zero_rate(spark, sf):
    return A.zero_denominator_report(_edge_parts(spark, sf).rows)


@register("missing_d1", _sql("""
SELECT acct, date, ticker, type, comment FROM _rows2 WHERE net2 IS NOT NULL AND ticker LIKE '%.US'""", PIPE))
def q_missing_d1(spark, sf):
    """F-4, on rows of US tickers that have lost their previous business day."""
    rows = _parts(spark, sf).rows
    lost = rows.withColumn("date_d1", F.when(~F.col("ticker").endswith(".US"), F.col("date_d1")))
    return Q.missing_d1(lost).select("acct", "date", "ticker", "type", "comment")


@register("invalid_rates", _sql("SELECT acct, date, ticker FROM _mm WHERE rate_source = 'default'", PIPE))
def q_invalid_rates(spark, sf):
    """F-9, where no default rate fills the gap."""
    merged = _parts(spark, sf).merged
    return Q.invalid_rates(merged.withColumn("wht_rate", F.when(F.col("rate_source") != "default", F.col("wht_rate"))))


@register("observed_checks", _sql(f"""
SELECT 'missing_d1' AS rule, CAST(0 AS BIGINT) AS violations, CAST(NULL AS VARCHAR) AS first_row
UNION ALL SELECT 'invalid_rate', count(*), min(concat_ws(' ', CAST(acct AS VARCHAR), CAST(date AS VARCHAR), ticker)) FROM rep_all WHERE wht_rate IS NULL
UNION ALL SELECT 'missing_fx', count(*), min(concat_ws(' ', CAST(acct AS VARCHAR), CAST(date AS VARCHAR), ticker)) FROM rep_all WHERE quarantined
""" + "".join(f"""UNION ALL SELECT '{name}', count(*), min(concat_ws(' ', CAST(acct AS VARCHAR), CAST(date AS VARCHAR), ticker)) FROM rep WHERE {bad}
""" for name, bad in (("null_date", "date IS NULL"), ("null_net", "net_dividend IS NULL"), ("null_shares", "shares IS NULL"), ("negative_shares", "shares < 0"),
                      ("bad_ticker", f"NOT {O.matches("COALESCE(ticker, '')", K.RE_TICKER)}"))), DAMAGED))
def q_observed_checks(spark, sf):
    """F-4, F-9, F-10, F-14 counted while the report is written."""
    from ..sources.report_io import scratch_path
    checks = Q.ReportChecks()
    build_report_parts(_damaged(spark, sf), _fx_index(spark, sf), checks=checks).report.write.parquet(scratch_path(spark, "checked"))
    return spark.createDataFrame([(name, n, first) for name, (n, first) in checks.violations().items()], "rule string, violations long, first_row string")


@register("tax_due_custom_rate", _sql("SELECT acct, date, ticker, wht_rate, tax_due_pln FROM rep", BASE + "," + O.pipeline_ctes(tax_rate=0.25)))
def q_tax_due_custom_rate(spark, sf):
    """M-6: another flat rate."""
    return _parts(spark, sf, TaxParams(tax_rate=0.25)).report.select("acct", "date", "ticker", "wht_rate", "tax_due_pln")


_EXPORT = REGISTRY["export_roundtrip"][1]
_ORDERED = _EXPORT.replace('SELECT CAST(acct AS VARCHAR) AS acct, strftime(date', """SELECT row_number() OVER (ORDER BY CAST(acct AS VARCHAR), date, ticker) AS ordinal,
       CAST(acct AS VARCHAR) AS acct, strftime(date""")


def _ordered_export(spark, sf):
    from ..sources.report_io import prepare_export, scratch_path, write_ordered
    display = display_report(_parts(spark, sf).report)
    return write_ordered(prepare_export(display.withColumn("acct", F.col("acct").cast("string"))), scratch_path(spark, "ordered"))


@register("export_ordered", _ORDERED)
def q_export_ordered(spark, sf):
    """O-1: every exported row with its place, read back."""
    from ..sources.report_io import read_ordered
    return read_ordered(spark, _ordered_export(spark, sf))


@register("export_without_raw_tax", _EXPORT)
def q_export_without_raw_tax(spark, sf):
    """P-17: the raw tax column goes where the percent column stands beside it."""
    from ..sources.report_io import report_roundtrip
    return report_roundtrip(spark, display_report(_parts(spark, sf).report).withColumn("Tax Collected", F.lit(0.5)))


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
