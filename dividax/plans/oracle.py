"""Independent SQL formulations (DuckDB dialect) of the registered queries.

These are the correctness oracles: the same semantics written as plain SQL over
the raw tables (``lineitem``, ``orders``, ``events`` ... registered as views).
The shared CTEs build the synthetic statements and FX rates of FIXTURES §2; the
helpers render the ordered rule cascades from the same fixed values the Spark
expressions use.
"""

from __future__ import annotations

from .. import constants as K
from ..sources.fx import FX_EPOCH, FX_FORMULAS, FX_HOLIDAY_DAYS
from ..sources.statements import ACCOUNT_CURRENCY_BY_ACCT, CURRENCY_BY_K, DAMAGED_COMMENTS, SUFFIX_BY_K, WHT_PCT_BY_W

TAX_RATE = K.DEFAULT_TAX_RATE


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


# --- scalar SQL helpers -----------------------------------------------------

def r2(x: str, digits: int = 2) -> str:
    scale = float(10 ** digits)
    return f"(round_even(({x}) * {scale}, 0) / {scale})"


def to_double(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '^[0-9]*\\.?[0-9]*$') AND regexp_matches({x}, '[0-9]') THEN TRY_CAST({x} AS DOUBLE) END)"


def matches(c: str, pattern: str) -> str:
    return f"COALESCE(regexp_matches({c}, {q(pattern)}), false)"


def extract(c: str, pattern: str, group: int) -> str:
    return f"NULLIF(regexp_extract({c}, {q(pattern)}, {group}), '')"


def per_share_dps(c: str) -> str:
    return (
        f"(CASE WHEN {matches(c, K.RE_WHT_CURRENCY)} THEN {to_double(f'regexp_extract({c}, {q(K.RE_PER_SHARE_LOOSE)}, 1)')}"
        f" WHEN {matches(c, K.RE_CUR_THEN_VALUE)} THEN {to_double(f'regexp_extract({c}, {q(K.RE_CUR_THEN_VALUE)}, 2)')}"
        f" WHEN {matches(c, K.RE_VALUE_THEN_CUR)} THEN {to_double(f'regexp_extract({c}, {q(K.RE_VALUE_THEN_CUR)}, 1)')}"
        f" WHEN {matches(c, K.RE_FIRST_NUMBER)} THEN {to_double(f'regexp_extract({c}, {q(K.RE_FIRST_NUMBER)}, 1)')} END)"
    )


def per_share_currency(c: str) -> str:
    return (
        f"(CASE WHEN {matches(c, K.RE_WHT_CURRENCY)} THEN {extract(c, K.RE_WHT_CURRENCY, 1)}"
        f" WHEN {matches(c, K.RE_CUR_THEN_VALUE)} THEN {extract(c, K.RE_CUR_THEN_VALUE, 1)}"
        f" WHEN {matches(c, K.RE_VALUE_THEN_CUR)} THEN {extract(c, K.RE_VALUE_THEN_CUR, 2)} END)"
    )


def wht_rate(c: str) -> str:
    return f"(TRY_CAST(COALESCE({extract(c, K.RE_WHT_RATE, 1)}, {extract(c, K.RE_ANY_RATE, 1)}) AS DOUBLE) / 100.0)"


def ticker_currency(t: str) -> str:
    parts = []
    for patterns, cur in K.TICKER_CURRENCY_RULES:
        cond = " OR ".join(f"contains({t}, {q(p)})" for p in patterns)
        parts.append(f"WHEN {cond} THEN {q(cur)}")
    return f"(CASE {' '.join(parts)} ELSE {q(K.TICKER_CURRENCY_DEFAULT)} END)"


def default_wht(t: str) -> str:
    parts = [f"WHEN contains({t}, {q(p)}) THEN {rate}" for p, rate in K.DEFAULT_WHT_RULES]
    return f"CAST(CASE {' '.join(parts)} ELSE {K.DEFAULT_WHT_FALLBACK} END AS DOUBLE)"


def keyword_label(c: str) -> str:
    parts = [f"WHEN {matches(f'lower({c})', chr(92) + 'b' + kw + chr(92) + 'b')} THEN {q(label)}" for kw, label in K.COMMENT_KEYWORDS]
    return f"(CASE {' '.join(parts)} ELSE {c} END)"


def prev_bday(d: str) -> str:
    return f"({d} - CASE isodow({d}) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END)"


def bidx(d: str) -> str:
    n = f"date_diff('day', DATE '1900-01-01', {d})"
    return f"(({n}) // 7 * 5 + least(({n}) % 7, 5))"


def pct_display(p: str) -> str:
    return f"(CASE WHEN {p} IS NULL OR {p} = 0 THEN '-' ELSE CAST(CAST(trunc({p} * 100.0) AS INTEGER) AS VARCHAR) || '%' END)"


# --- shared CTEs ------------------------------------------------------------

def damaged_cte() -> str:
    """``stmt`` with the damage of ``damaged_statements``; follows ``stmt_cte`` renamed to ``stmt0``."""
    forms = " ".join(f"WHEN {d} THEN {q(text)}" for d, text in DAMAGED_COMMENTS.items())
    return stmt_cte().replace("\nstmt AS (", "\nstmt0 AS (") + f""",
stmt AS (
  SELECT CASE WHEN day("Time") <> 17 THEN id END AS id, acct, account_currency,
         CASE WHEN day("Time") <> 13 THEN "Type" END AS "Type", CASE WHEN day("Time") <> 11 THEN "Time" END AS "Time",
         CASE day("Time") WHEN 3 THEN NULL {forms} ELSE "Comment" END AS "Comment",
         CASE day("Time") WHEN 7 THEN 'bad ' || "Symbol" WHEN 5 THEN NULL ELSE "Symbol" END AS "Symbol", "Amount"
  FROM stmt0)"""


def stmt_cte() -> str:
    """FIXTURES §2.1 statements as ``stmt(id, acct, account_currency, Type, Time, Comment, Symbol, Amount)``."""
    return f"""
_li AS (
  SELECT l_orderkey AS ok, l_linenumber AS ln, CAST(l_orderkey % 4 AS INTEGER) AS acct, l_shipdate AS "Time",
         CASE WHEN l_suppkey % 16 = 15 THEN 'ASB.PL'
              ELSE 'S' || CAST(l_suppkey % 20 AS VARCHAR) || {sql_list(SUFFIX_BY_K)}[l_suppkey % 16 + 1] END AS "Symbol",
         {sql_list(CURRENCY_BY_K)}[l_suppkey % 16 + 1] AS cur,
         l_partkey % 400 + 1 AS n, CAST(l_quantity AS INTEGER) AS qq, l_orderkey % 7 AS w
  FROM lineitem),
_legs AS (
  SELECT 'D' || CAST(ok AS VARCHAR) || '-' || CAST(ln AS VARCHAR) AS id, acct,
         CASE WHEN ln = 7 THEN 'Deposit' WHEN ln % 2 = 0 THEN 'Dividend' ELSE 'Dywidenda' END AS "Type",
         "Time",
         CASE WHEN ln = 7 THEN 'Blik top up'
              ELSE "Symbol" || ' ' || cur || ' ' || CAST(n // 100 AS VARCHAR) || '.' || lpad(CAST(n % 100 AS VARCHAR), 2, '0') || '00/ SHR' END AS "Comment",
         "Symbol",
         CAST(CAST(qq * n AS DECIMAL(18,6)) * CAST(0.01 AS DECIMAL(18,6)) AS DECIMAL(18,6)) AS "Amount"
  FROM _li
  UNION ALL
  SELECT 'T' || CAST(ok AS VARCHAR) || '-' || CAST(ln AS VARCHAR), acct,
         CASE WHEN ln % 2 = 0 THEN 'Withholding Tax' ELSE 'Podatek od dywidend' END,
         "Time",
         "Symbol" || ' ' || cur || ' WHT ' || CAST({sql_list(WHT_PCT_BY_W)}[w + 1] AS VARCHAR) || '%',
         "Symbol",
         CAST(-(CAST(qq * n AS DECIMAL(18,6)) * CAST(0.001 AS DECIMAL(18,6))) AS DECIMAL(18,6))
  FROM _li WHERE w < 5 AND ln <> 7),
stmt AS (
  SELECT id, acct, {sql_list(ACCOUNT_CURRENCY_BY_ACCT)}[acct + 1] AS account_currency,
         "Type", "Time", "Comment", "Symbol", "Amount" FROM _legs)"""


def fx_cte(edge: bool = False) -> str:
    """FIXTURES §2.2 rates as ``fx(currency, rate_date, rate)``; ``edge``: with weekend-dated and zero rates."""
    weekend = "OR (isodow(rate_date) > 5 AND day(rate_date) % 3 = 0)" if edge else ""
    zero = "CASE WHEN day(rate_date) = 10 THEN 0.0 ELSE" if edge else "("
    close = "END" if edge else ")"
    days = f"""
_fxd AS (
  SELECT rate_date, date_diff('day', DATE '{FX_EPOCH}', rate_date) AS n
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders)
  WHERE (isodow(rate_date) <= 5 AND day(rate_date) NOT IN ({', '.join(str(d) for d in FX_HOLIDAY_DAYS)})) {weekend})"""
    unions = " UNION ALL ".join(
        f"SELECT '{cur}' AS currency, rate_date, {zero} CAST({base} + (n * {step}) % {span} AS DOUBLE) / {scale} {close} AS rate FROM _fxd"
        for cur, base, step, span, scale in FX_FORMULAS
    )
    return days + f",\nfx AS ({unions})"


def fx_lookup_ctes(src: str, key_cur: str, key_date: str, out: str, name: str) -> str:
    """Bounded as-of look-up of ``(key_cur, key_date)`` rows of ``src`` into column ``out``.

    Weekday rates: ASOF join (latest rate on or before the date) kept only within
    the look-back; a weekend-dated rate serves its own date only and wins there."""
    lb = K.FX_LOOKBACK_PROBES
    return f"""
{name}_a AS (
  SELECT s.*, f.rate AS _wk_rate, f.rate_date AS _wk_date
  FROM {src} s ASOF LEFT JOIN (SELECT * FROM fx WHERE isodow(rate_date) <= 5) f
    ON s.{key_cur} = f.currency AND s.{key_date} >= f.rate_date),
{name} AS (
  SELECT a.* EXCLUDE (_wk_rate, _wk_date),
         CASE WHEN a.{key_cur} IS NULL OR a.{key_date} IS NULL THEN NULL
              WHEN a.{key_cur} = 'PLN' THEN 1.0
              WHEN we.rate IS NOT NULL THEN we.rate
              WHEN {bidx(f'a.{key_date}')} - {bidx('a._wk_date')} < {lb} THEN a._wk_rate END AS {out}
  FROM {name}_a a LEFT JOIN (SELECT * FROM fx WHERE isodow(rate_date) > 5) we
    ON a.{key_cur} = we.currency AND a.{key_date} = we.rate_date)"""


def total(amount: str) -> str:
    return r2(f"COALESCE(CAST(SUM({amount}) AS DOUBLE), 0.0)")


def pipeline_ctes(tax_rate: float = TAX_RATE, convert_all: bool = False) -> str:
    """The flagship pipeline up to the report grain: CTE ``rep`` (plus intermediates)."""
    foreign = "cur_any <> 'PLN'" if convert_all else "cur_any = 'USD'"
    return f"""
_rows AS (
  SELECT acct, account_currency, CAST("Time" AS DATE) AS date, "Symbol" AS ticker, "Type" AS type,
         {keyword_label('"Comment"')} AS comment, "Amount" AS amount
  FROM stmt),
_g AS (
  SELECT acct, account_currency, date, ticker, type, comment, COALESCE(SUM(amount), 0) AS net0
  FROM _rows
  WHERE type IN {in_list(K.DIVIDEND_TYPES)} AND date IS NOT NULL AND ticker IS NOT NULL AND comment IS NOT NULL
  GROUP BY acct, account_currency, date, ticker, type, comment),
_s AS (
  SELECT acct, account_currency, date, ticker, type, comment,
         CASE WHEN net0 < 0 THEN net0 END AS wht_raw,
         CAST(CASE WHEN net0 >= 0 THEN net0 END AS DOUBLE) AS net1,
         {prev_bday('date')} AS date_d1,
         {per_share_dps('comment')} AS dps,
         {per_share_currency('comment')} AS xcur
  FROM _g),
_e AS (
  SELECT *, (date IS NOT NULL AND net1 IS NOT NULL AND comment IS NOT NULL AND dps IS NOT NULL AND dps > 0) AS elig,
         CASE WHEN COALESCE(xcur, '') <> '' THEN xcur ELSE {ticker_currency('ticker')} END AS cur_any
  FROM _s),
_n AS (
  SELECT *, CASE WHEN elig THEN cur_any END AS dividend_cur,
         COALESCE(elig AND account_currency = 'PLN' AND {foreign}, false) AS needs_fx,
         CASE WHEN COALESCE(elig AND account_currency = 'PLN' AND {foreign}, false) THEN cur_any END AS fx_key
  FROM _e),
{fx_lookup_ctes('_n', 'fx_key', 'date_d1', 'fx_sh', '_f')},
_sh AS (
  SELECT *, CASE WHEN needs_fx THEN fx_sh ELSE 1.0 END AS fxu FROM _f),
_sh2 AS (
  SELECT *, CASE WHEN elig THEN (CASE WHEN dps * fxu = 0 THEN 0.0 ELSE round_even(net1 / (dps * fxu), 0) END) END AS shares,
         (needs_fx AND fx_sh IS NULL) AS fx_missing_sh,
         COALESCE(elig AND dps * fxu = 0, false) AS zero_den
  FROM _sh),
_rows2 AS (
  SELECT *, CASE WHEN elig THEN shares * dps ELSE net1 END AS net2, {r2(wht_rate('comment'))} AS row_rate FROM _sh2),
_m AS (
  SELECT acct, account_currency, date, ticker,
         COALESCE(CAST(SUM(CAST(net2 AS DECIMAL(28,8))) AS DOUBLE), 0.0) AS _net, COALESCE(SUM(shares), 0.0) AS _shares,
         arg_min(row_rate, CASE WHEN row_rate IS NOT NULL THEN row(type, comment) END) AS crate,
         COALESCE(CAST(SUM(wht_raw) AS DOUBLE), 0.0) AS wht_raw,
         bool_or(fx_missing_sh) AS fx_missing_shares,
         CAST(count_if(zero_den) AS BIGINT) AS zero_denominator_rows
  FROM _rows2 GROUP BY acct, account_currency, date, ticker),
_mm AS (
  SELECT acct, account_currency, date, ticker,
         {r2('_net')} AS net_dividend, {r2('_shares')} AS shares,
         {r2(f"COALESCE(crate, {r2(default_wht('ticker'))})")} AS wht_rate,
         CASE WHEN crate IS NOT NULL THEN 'comment' ELSE 'default' END AS rate_source,
         wht_raw, fx_missing_shares, zero_denominator_rows
  FROM _m),
_t AS (
  SELECT *, {pct_display('wht_rate')} AS wht_pct, {ticker_currency('ticker')} AS dividend_currency,
         CASE WHEN NOT (wht_rate >= {tax_rate}) THEN {prev_bday('date')} END AS date_d1,
         NOT (wht_rate >= {tax_rate}) AND {ticker_currency('ticker')} <> 'PLN' AS needs_fx2,
         {ticker_currency('ticker')} AS fx_key2, {prev_bday('date')} AS fx_day2
  FROM _mm),
{fx_lookup_ctes('_t', 'fx_key2', 'fx_day2', 'fx_lab', '_l')},
_w AS (
  SELECT *,
         CASE WHEN needs_fx2 AND fx_lab <> 0 THEN {r2('fx_lab', 4)} END AS fx_rate_d1,
         {r2('fx_lab', 4)} AS fx_rate_gross,
         (needs_fx2 AND fx_lab IS NULL) AS fx_missing_report,
         CASE WHEN wht_rate IS NULL OR wht_rate = 0 THEN NULL
              ELSE {r2("CASE WHEN account_currency = 'USD' AND wht_raw IS NOT NULL AND wht_raw <> 0 THEN abs(wht_raw) ELSE (CASE WHEN 1.0 - wht_rate = 0 THEN NULL ELSE net_dividend / (1.0 - wht_rate) END) * wht_rate END")} END AS wht_amount
  FROM _l),
_d AS (
  SELECT *, {r2(f"((CASE WHEN account_currency = 'USD' THEN net_dividend + COALESCE(wht_amount, 0.0) ELSE net_dividend END) * {tax_rate} - COALESCE(wht_amount, 0.0)) * COALESCE(fx_rate_d1, 1.0)")} AS _due
  FROM _w),
rep_all AS (
  SELECT *, CASE WHEN wht_rate IS NULL OR wht_rate >= {tax_rate} OR _due = 0 THEN NULL ELSE _due END AS tax_due_pln,
         COALESCE(fx_missing_shares, false) OR fx_missing_report AS quarantined
  FROM _d),
rep AS (
  SELECT acct, account_currency, date, ticker, shares, net_dividend, dividend_currency, wht_amount, wht_pct,
         wht_rate, date_d1, fx_rate_d1, tax_due_pln
  FROM rep_all WHERE NOT quarantined)"""
