"""Property-based check of the comment parsers (T-1, T-3): comments built from known amounts, currencies and rates."""

from hypothesis import given, settings
from hypothesis import strategies as st

from dividax.functions import text as T

amounts = st.integers(1, 99_999).map(lambda n: n / 10_000)
currencies = st.sampled_from(["USD", "EUR", "PLN", "GBP"])
rates = st.integers(0, 99)


@st.composite
def comments(draw):
    """(comment, amount, currency, rate) with the answer known from how the comment is made."""
    amount, currency, rate = draw(amounts), draw(currencies), draw(rates)
    number = f"{amount:.4f}"
    return draw(st.sampled_from([
        (f"X.US {currency} {number}/ SHR", amount, currency, None),
        (f"{number} {currency}/SHR", amount, currency, None),
        (f"{number}", amount, None, None),
        (f"ABC.US {currency} WHT {rate}%", None, currency, rate / 100),
        ("no figures here", None, None, None),
    ]))


@settings(max_examples=40, deadline=None)
@given(st.lists(comments(), min_size=1, max_size=40))
def test_parsers_find_what_was_put_in(spark, batch):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(batch)], "i int, c string")
    staged = T.per_share_columns(df, "c", "dps", "cur").select("i", "dps", "cur", T.wht_rate_from_comment("c").alias("rate"))
    for r in staged.collect():
        _, amount, currency, rate = batch[r["i"]]
        assert (r["dps"], r["cur"]) == (amount, currency), batch[r["i"]]
        assert r["rate"] is None if rate is None else abs(r["rate"] - rate) < 1e-12, batch[r["i"]]
