"""Statement sources.

``synthetic_statements`` derives broker cash-operation rows from ``lineitem``
(two legs per line: a dividend leg and, for most lines, a withholding-tax leg),
exactly as FIXTURES §2.1 defines them, so the SQL oracle can build the same rows.
The derivation is a narrow projection + ``union``: no shuffle, pruned scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K

# FIXED VALUES of the synthetic statement generator (FIXTURES §2.1), by k = l_suppkey % 16.
SUFFIX_BY_K = (".US", ".PL", ".UK", ".DK", ".FR", ".DE", ".IE", ".NL", ".US", ".PL", ".US", ".DK", ".FI", ".PT", ".SE")
CURRENCY_BY_K = ("USD", "PLN", "GBP", "DKK", "EUR", "EUR", "EUR", "EUR", "USD", "PLN", "USD", "DKK", "EUR", "EUR", "USD", "USD")
#: WHT percentage of the tax leg by w = l_orderkey % 7 (w in 5, 6: no tax leg).
WHT_PCT_BY_W = (15, 19, 30, 27, 10)
#: Account currency by acct = l_orderkey % 4.
ACCOUNT_CURRENCY_BY_ACCT = ("PLN", "PLN", "USD", "EUR")



def _pick(values: tuple, index: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def account_currency_of(acct: Column) -> Column:
    return _pick(ACCOUNT_CURRENCY_BY_ACCT, acct)


def synthetic_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw statement rows (English headers) for all accounts.

    Columns: ``id, acct, account_currency, Type, Time (TIMESTAMP), Comment, Symbol, Amount DECIMAL(18,6)``.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    n = F.col("l_partkey") % 400 + 1
    q = F.col("l_quantity").cast("int")
    w = F.col("l_orderkey") % 7
    k = F.col("l_suppkey") % 16
    ln = F.col("l_linenumber")
    symbol = F.when(k == 15, F.lit("ASB.PL")).otherwise(
        F.concat(F.lit("S"), (F.col("l_suppkey") % 20).cast("string"), _pick(SUFFIX_BY_K, k))
    )
    cur = _pick(CURRENCY_BY_K, k)
    base = li.select(
        F.col("l_orderkey").alias("ok"),
        ln.alias("ln"),
        (F.col("l_orderkey") % 4).cast("int").alias("acct"),
        F.col("l_shipdate").alias("Time"),
        symbol.alias("Symbol"),
        cur.alias("cur"),
        n.alias("n"),
        q.alias("q"),
        w.alias("w"),
    )
    qn = (F.col("q") * F.col("n")).cast("decimal(18,2)")
    ok_ln = F.concat(F.col("ok").cast("string"), F.lit("-"), F.col("ln").cast("string"))
    # one scan of lineitem; each line becomes one or two legs, whose texts are made after that, so that unread ones never are
    legs = F.when((F.col("w") < 5) & (F.col("ln") != 7), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    tax, even, deposit = F.col("tax"), F.col("ln") % 2 == 0, F.col("ln") == 7
    per_share = F.concat_ws(
        "",
        F.col("Symbol"), F.lit(" "), F.col("cur"), F.lit(" "),
        F.floor(F.col("n") / 100).cast("string"), F.lit("."),
        F.lpad((F.col("n") % 100).cast("string"), 2, "0"), F.lit("00/ SHR"),
    )
    withheld = F.concat_ws(
        "", F.col("Symbol"), F.lit(" "), F.col("cur"), F.lit(" WHT "),
        _pick(WHT_PCT_BY_W, F.col("w")).cast("string"), F.lit("%"),
    )
    return base.select("*", F.explode(legs).alias("tax")).select(
        F.concat(F.when(tax, "T").otherwise("D"), ok_ln).alias("id"),
        "acct",
        account_currency_of(F.col("acct")).alias("account_currency"),
        F.when(tax, F.when(even, "Withholding Tax").otherwise("Podatek od dywidend"))
        .otherwise(F.when(deposit, "Deposit").when(even, "Dividend").otherwise("Dywidenda")).alias("Type"),
        "Time",
        F.when(tax, withheld).otherwise(F.when(deposit, F.lit("Blik top up")).otherwise(per_share)).alias("Comment"),
        "Symbol",
        F.when(tax, (-(qn / 1000)).cast("decimal(18,6)")).otherwise((qn / 100).cast("decimal(18,6)")).alias("Amount"),
    )


#: Damage of ``damaged_statements`` by day of month: the column and what it becomes.
DAMAGED_COMMENTS = {
    19: "USD WHT 15% 0.4500 / SHR", 20: "0.4500 USD/SHR", 21: "0.4500", 22: "1.2.3 USD/SHR", 23: "no figures",
    24: "Transfer Pekao", 25: "USD 0.0000/ SHR", 26: "ABC.US bonus", 27: "USD 0.3000/ SHR 5 %",
}


def damaged_statements(stmt: DataFrame) -> DataFrame:
    """The same rows with NULLs, malformed tickers and other comment forms, by day of month."""
    day = F.dayofmonth("Time")
    comment = F.when(day == 3, F.lit(None))
    for d, text in DAMAGED_COMMENTS.items():
        comment = comment.when(day == d, F.lit(text))
    return stmt.select(
        F.when(day != 17, F.col("id")).alias("id"), "acct", "account_currency", F.when(day != 13, F.col("Type")).alias("Type"),
        F.when(day != 11, F.col("Time")).alias("Time"), comment.otherwise(F.col("Comment")).alias("Comment"),
        F.when(day == 7, F.concat(F.lit("bad "), "Symbol")).when(day != 5, F.col("Symbol")).alias("Symbol"), "Amount",
    )


def with_time_text(stmt: DataFrame) -> DataFrame:
    """Add ``time_text``: the statement time rendered as ``dd.MM.yyyy HH:mm:ss`` (input of C-1)."""
    return stmt.withColumn("time_text", F.date_format(F.col("Time"), "dd.MM.yyyy HH:mm:ss"))


def polish_headers(stmt: DataFrame) -> DataFrame:
    """The same rows with Polish headers (input of the header normaliser)."""
    inverse = {en: pl for pl, en in K.POLISH_HEADERS.items()}
    return stmt.withColumnsRenamed({en: pl for en, pl in inverse.items() if en in stmt.columns})
