"""Text parsing expressions (T-1 .. T-11, J-5 .. J-7).

Every parser is an ordered cascade of ``regexp_extract`` / ``try_cast`` branches,
so it runs inside whole-stage codegen; nothing leaves the JVM.
``regexp_extract`` yields ``''`` on no match, hence the ``nullif`` guards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _extract(c: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def _matches(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def _to_double(text: Column) -> Column:
    """Text of digits and dots -> DOUBLE; more than one dot, or no digit (``.``) -> NULL.

    Callers only pass runs of ``[0-9.]``, for which ``try_cast`` is exactly this rule
    (``1.`` and ``.5`` parse, ``1.2.3`` and ``.`` do not)."""
    return text.try_cast("double")


# Whole-match forms of the cascade patterns.  ``regexp_substr`` returns the first
# match or NULL, so each pattern runs once per row (no ``nullif`` re-evaluation);
# the parts are then cut out of the short match text.
_A_MATCH = r"[A-Z]{3}\s+WHT"             # "<CUR> WHT"
_A_VALUE = r"[\d.]+\s*/\s*SHR"          # "<num> / SHR" anywhere in a WHT comment
_B_MATCH = r"[A-Z]{3} [\d.]+/ SHR"       # "<CUR> <num>/ SHR"
_C_MATCH = r"[\d.]+ [A-Z]{3}/SHR"        # "<num> <CUR>/SHR"
_NUM = r"[\d.]+"
_RATE_WHT = r"WHT\s*\d+(?:\.\d+)?%"
_RATE_ANY = r"\d+(?:\.\d+)?\s*%"
_RATE_NUM = r"\d+(?:\.\d+)?"


def _find(c: Column, pattern: str) -> Column:
    return F.regexp_substr(c, F.lit(pattern))


def per_share_columns(df, comment: str = "comment", dps: str = "dps", currency: str = "currency"):
    """T-1 as a DataFrame step: adds ``dps`` and ``currency`` parsed from ``comment``.

    Ordered cascade, first branch that matches decides:
      (a) ``XXX WHT``       -> currency; value only if ``<num> / SHR`` is also present
      (b) ``XXX <num>/ SHR``
      (c) ``<num> XXX/SHR``
      (d) the first run of digits/dots, no currency (all dots -> both NULL)

    Each branch's regular expression runs at most once per row and only when the
    earlier branches failed and a cheap substring guard passes; the branch matches
    are staged as columns so no expression is evaluated twice.
    """
    c = F.col(comment)
    pa, pb, pc, pd = F.col("_pa"), F.col("_pb"), F.col("_pc"), F.col("_pd")
    staged = df.withColumn("_pa", F.when(c.contains("WHT"), _find(c, _A_MATCH)))
    staged = staged.withColumn("_pb", F.when(pa.isNull() & c.contains("/ SHR"), _find(c, _B_MATCH)))
    staged = staged.withColumn("_pc", F.when(pa.isNull() & pb.isNull() & c.contains("/SHR"), _find(c, _C_MATCH)))
    staged = staged.withColumn("_pd", F.when(pa.isNull() & pb.isNull() & pc.isNull(), _find(c, _NUM)))
    value = (
        F.when(pa.isNotNull(), _to_double(_find(F.when(c.contains("SHR"), _find(c, _A_VALUE)), _NUM)))
        .when(pb.isNotNull(), _to_double(F.expr("substring(_pb, 5, length(_pb) - 9)")))
        .when(pc.isNotNull(), _to_double(F.expr("substring(_pc, 1, length(_pc) - 8)")))
        .when(pd.isNotNull(), _to_double(pd))
    )
    cur = (
        F.when(pa.isNotNull(), F.substring(pa, 1, 3))
        .when(pb.isNotNull(), F.substring(pb, 1, 3))
        .when(pc.isNotNull(), F.expr("substring(_pc, length(_pc) - 6, 3)"))
    )
    return staged.withColumns({dps: value, currency: cur}).drop("_pa", "_pb", "_pc", "_pd")


def per_share_from_comment(comment: Column | str) -> Column:
    """T-1 as a single Column expression (``struct(dps, currency)``), same cascade as
    :func:`per_share_columns`; convenient for ad-hoc use on small inputs."""
    c = _col(comment)
    a = c.contains("WHT") & _matches(c, K.RE_WHT_CURRENCY)
    b = c.contains("/ SHR") & _matches(c, K.RE_CUR_THEN_VALUE)
    cc = c.contains("/SHR") & _matches(c, K.RE_VALUE_THEN_CUR)
    d = _matches(c, K.RE_FIRST_NUMBER)
    dps = (
        F.when(a, _to_double(F.regexp_extract(c, K.RE_PER_SHARE_LOOSE, 1)))
        .when(b, _to_double(F.regexp_extract(c, K.RE_CUR_THEN_VALUE, 2)))
        .when(cc, _to_double(F.regexp_extract(c, K.RE_VALUE_THEN_CUR, 1)))
        .when(d, _to_double(F.regexp_extract(c, K.RE_FIRST_NUMBER, 1)))
    )
    cur = (
        F.when(a, _extract(c, K.RE_WHT_CURRENCY, 1))
        .when(b, _extract(c, K.RE_CUR_THEN_VALUE, 1))
        .when(cc, _extract(c, K.RE_VALUE_THEN_CUR, 2))
    )
    return F.struct(dps.alias("dps"), cur.alias("currency"))


def wht_rate_from_comment(comment: Column | str) -> Column:
    """T-3: withholding-tax fraction from a comment (``WHT 15%`` first, else any ``n%``), else NULL."""
    c = _col(comment)
    first = _find(_find(c, _RATE_WHT), _RATE_NUM)
    pct = F.when(c.contains("%"), F.coalesce(first, _find(_find(c, _RATE_ANY), _RATE_NUM)))
    return pct.try_cast("double") / F.lit(100.0)


def ticker_currency(ticker: Column | str) -> Column:
    """J-5: ordered substring rules ticker -> currency, default USD."""
    t = _col(ticker)
    expr = None
    for patterns, currency in K.TICKER_CURRENCY_RULES:
        cond = None
        for p in patterns:
            hit = t.contains(p)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, F.lit(currency)) if expr is None else expr.when(cond, F.lit(currency))
    return expr.otherwise(F.lit(K.TICKER_CURRENCY_DEFAULT))


def dividend_currency(ticker: Column | str, extracted: Column | str) -> Column:
    """T-2: currency stated in the comment if any (non-empty), else the ticker rule."""
    e = _col(extracted)
    return F.when(F.coalesce(e, F.lit("")) != "", e).otherwise(ticker_currency(ticker))


def default_wht_rate(ticker: Column | str) -> Column:
    """J-6: ordered substring rules ticker -> default withholding-tax fraction."""
    t = _col(ticker)
    expr = None
    for pattern, rate in K.DEFAULT_WHT_RULES:
        cond = t.contains(pattern)
        expr = F.when(cond, F.lit(rate)) if expr is None else expr.when(cond, F.lit(rate))
    return expr.otherwise(F.lit(K.DEFAULT_WHT_FALLBACK))


def keyword_label(comment: Column | str) -> Column:
    """J-7: whole-word, case-insensitive keyword -> canonical label; otherwise the comment itself."""
    c = _col(comment)
    low = F.lower(c)
    expr = None
    for keyword, label in K.COMMENT_KEYWORDS:
        cond = low.contains(keyword) & _matches(low, r"\b" + keyword + r"\b")
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(c)


def strip_ansi(text: Column | str) -> Column:
    """T-8: remove ANSI escape sequences."""
    return F.regexp_replace(_col(text), K.RE_ANSI, "")


def money_text(value: Column | str) -> Column:
    """A 2-dp amount as the original prints a float: shortest form with at least one
    decimal (``45.5``, ``45.51``, ``100.0``), never scientific notation."""
    return F.regexp_replace(_col(value).cast("decimal(38,2)").cast("string"), "0$", "")


def amount_text(value: Column | str, currency: Column | str) -> Column:
    """P-11 (sink side): ``"<value> <CUR>"`` label of a 2-dp amount."""
    return F.concat_ws(" ", money_text(value), _col(currency))


def parse_amount_text(text: Column | str) -> Column:
    """T-5: ``"<num> <CUR>"`` -> ``struct(value, currency)``; exactly two whitespace tokens, else NULLs."""
    s = F.trim(_col(text))
    parts = F.split(s, r"\s+")
    ok = (F.size(parts) == 2) & (s != "") & (F.lower(s) != "nan")
    num = F.element_at(parts, 1)
    value = F.when(ok & num.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), num.try_cast("double"))
    return F.struct(value.alias("value"), F.when(value.isNotNull(), F.element_at(parts, 2)).alias("currency"))


def _is_placeholder(text: Column) -> Column:
    return text.isNull() | F.trim(text).isin("-", "nan")


def parse_wht_amount_text(text: Column | str) -> Column:
    """T-6: ``-``/``nan``/NULL -> 0.0, else the numeric part of ``"<num> <CUR>"``."""
    t = _col(text)
    return F.when(_is_placeholder(t), F.lit(0.0)).otherwise(parse_amount_text(t)["value"])


def parse_fx_text(text: Column | str) -> Column:
    """T-7: ``-``/``nan``/NULL -> 1.0, else the numeric part of ``"<num> PLN"``."""
    t = _col(text)
    return F.when(_is_placeholder(t), F.lit(1.0)).otherwise(parse_amount_text(t)["value"])


def currency_symbol(text: Column | str) -> Column:
    """T-9: ``PLN`` if the text contains PLN, ``$`` if it contains USD, else empty."""
    t = F.coalesce(_col(text).cast("string"), F.lit(""))
    return F.when(t.contains("PLN"), F.lit("PLN")).when(t.contains("USD"), F.lit("$")).otherwise(F.lit(""))


def digits_only_number(text: Column | str) -> Column:
    """T-10: keep ``[0-9.]`` only and read as DOUBLE (a minus sign is lost, as in the original)."""
    kept = F.regexp_replace(_col(text).cast("string"), r"[^0-9.]", "")
    return _to_double(kept)


def severity_level(severity: Column | str) -> Column:
    """T-11: finding severity -> report level, default ``note``."""
    s = _col(severity)
    expr = None
    for name, level in K.SEVERITY_LEVELS:
        expr = F.when(s == name, F.lit(level)) if expr is None else expr.when(s == name, F.lit(level))
    return expr.otherwise(F.lit("note"))


def number_from_text(value: Column) -> Column:
    """P-7: a decimal number as DOUBLE; any other text (``nan``, ``inf``, ``1d``, ``1.2.3``, blanks) is NULL."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(K.NUMBER_PATTERN), text.try_cast("double"))
