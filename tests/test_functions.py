"""Scalar helpers against plain-Python references on generated batches."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from pickbay.functions import capped_share, clamp_positive, ratio_or_default, text_to_int

SETTINGS = settings(max_examples=8, deadline=None)
ints = st.integers(min_value=-50, max_value=2000)


def _half_up(x: float, digits: int) -> float:
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), ints), st.one_of(st.none(), ints)), min_size=1, max_size=40))
def test_ratio_or_default(spark, rows):
    df = spark.createDataFrame([(None if a is None else float(a), None if b is None else float(b), 0.5)
                                for a, b in rows], "num double, den double, d double")
    got = [r.v for r in df.select(ratio_or_default("num", "den", "d").alias("v")).collect()]
    want = [0.5 if a is None or b is None or b == 0 else _half_up(a / b, 4) for a, b in rows]
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-5, max_value=10_000_000)), min_size=1, max_size=40))
def test_clamp_positive(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "q bigint")
    got = [(r.a, r.b) for r in df.select(clamp_positive("q").alias("a"),
                                         clamp_positive("q", 999999).alias("b")).collect()]
    want = [(v if v is not None and v > 0 else 0, v if v is not None and 0 < v < 999999 else 0) for v in values]
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(repr),
                          st.sampled_from(["", "x", "12.7", "-3.9", " 4", "1e3"])), min_size=1, max_size=40))
def test_text_to_int(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in df.select(text_to_int("t").alias("v")).collect()]

    def ref(t):
        if t is None:
            return None
        try:
            return int(float(t))  # truncation towards zero
        except ValueError:
            return None
    assert got == [ref(t) for t in texts]


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=100), min_size=1, max_size=20))
def test_capped_share(spark, pct):
    df = spark.createDataFrame([(p / 100,) for p in pct], "r double")
    got = [r.s for r in df.select(capped_share("r", 0.15).alias("s")).collect()]
    assert got == [min(Decimal(p) / 100 + Decimal("0.15"), Decimal(1)).quantize(Decimal("0.01")) for p in pct]
