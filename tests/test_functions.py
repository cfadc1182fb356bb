"""Edge rows for the scalar expressions (bucket edges, NULLs, clamps, exact
rounding at ties and beyond the BIGINT fast path)."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions import (
    dpd_bucket, large_amount_flag, off_hours, off_hours_list, pct, pd_score, round_ratio, score_band,
)


def _round_half_up(fr: Fraction, scale: int) -> Fraction:
    p = 10 ** scale
    x = abs(fr) * p
    q = (x * 2 + 1) // 2
    return (q / p) * (1 if fr >= 0 else -1)


def _round_half_even(fr: Fraction, scale: int) -> Fraction:
    p = 10 ** scale
    x = abs(fr) * p
    q, r = divmod(x.numerator, x.denominator)
    if 2 * r > x.denominator or (2 * r == x.denominator and q % 2 == 1):
        q += 1
    return (Fraction(q) / p) * (1 if fr >= 0 else -1)


CASES = [(46, 8000), (1, 8), (3, 8), (5, 8), (1005, 100000), (-46, 8000), (46, -8000), (0, 5),
         (0, -5), (2, 3), (10 ** 17 + 5, 2 * 10 ** 15), (123456789012345678, 10 ** 16 + 7),
         (7, 0), (None, 3), (3, None)]


@pytest.mark.parametrize("mode", ["half_up", "half_even"])
def test_round_ratio_exact(spark, mode):
    df = spark.createDataFrame(CASES, "n long, d long")
    got = df.select("n", "d", round_ratio("n", "d", 2, mode).alias("r"),
                    pct("n", "d", 2, mode).alias("p")).collect()
    ref = _round_half_up if mode == "half_up" else _round_half_even
    for row in got:
        if row.n is None or row.d is None or row.d == 0:
            assert row.r is None and row.p is None
            continue
        assert row.r == float(ref(Fraction(row.n, row.d), 2)), (row, mode)
        assert row.p == float(ref(Fraction(row.n * 100, row.d), 2)), (row, mode)
        assert str(row.r) != "-0.0"


def test_dpd_bucket_edges(spark):
    vals = [None, -5, 0, 30, 31, 60, 61, 90, 91, 180, 181]
    df = spark.createDataFrame([(v,) for v in vals], "d int")
    got = [r.b for r in df.select(dpd_bucket("d").alias("b")).collect()]
    labels = dict(K.DPD_BUCKETS)
    assert got == [K.DPD_OVERFLOW_LABEL, labels[30], K.DPD_CURRENT_LABEL, labels[30], labels[60],
                   labels[60], labels[90], labels[90], labels[180], labels[180], K.DPD_OVERFLOW_LABEL]


def test_score_band_edges(spark):
    vals = [None, 599, 600, 649, 650, 699, 700, 749, 750, 799, 800]
    df = spark.createDataFrame([(v,) for v in vals], "s int")
    got = [r.b for r in df.select(score_band("s").alias("b")).collect()]
    b = dict(K.SCORE_BANDS)
    assert got == [K.SCORE_FLOOR_LABEL, K.SCORE_FLOOR_LABEL, b[600], b[600], b[650], b[650], b[700],
                   b[700], b[750], b[750], b[800]]


def test_off_hours_edges(spark):
    df = spark.createDataFrame([(h,) for h in [22, 23, 0, 5, 6]], "h int")
    got = [r.x for r in df.select(off_hours("h").alias("x")).collect()]
    assert got == [False, True, True, True, False]
    listed = [r.x for r in df.select(F.col("h").isin(off_hours_list()).alias("x")).collect()]
    assert listed == got
    assert sorted(off_hours_list()) == [0, 1, 2, 3, 4, 5, 23]


def test_pd_clamps_and_unknown_score(spark):
    df = spark.createDataFrame([(s,) for s in [300, 399, 400, 830, 831, None]], "s int")
    got = [r.p for r in df.select(pd_score("s").alias("p")).collect()]
    assert got == [0.45, 0.45, 0.45, 0.02, 0.02, 0.2]


def test_large_amount_flag(spark):
    df = spark.createDataFrame([(a,) for a in [199999.99, 200000.0, 200000.01, None]], "a double")
    assert [r.f for r in df.select(large_amount_flag("a").alias("f")).collect()] == [0, 0, 1, 0]


@pytest.mark.parametrize("mode", ["half_up", "half_even"])
def test_round_ratio_random_magnitudes(spark, mode):
    """Random ratios from tiny to beyond the BIGINT fast path, a fifth of them
    exact ties at the rounding digit, against exact rational rounding."""
    import random

    rnd = random.Random(11)
    rows = []
    for _ in range(3000):
        scale = rnd.choice([0, 1, 2])
        if rnd.random() < 0.2:  # n / d * 10^scale = m + 1/2 exactly
            k = rnd.randint(1, 10 ** 6)
            m = rnd.randint(-10 ** 6, 10 ** 6)
            n, d = (2 * m + 1) * k, 2 * 10 ** scale * k
        else:
            mag = rnd.choice([10, 10 ** 4, 10 ** 9, 10 ** 14, 10 ** 17])
            n, d = rnd.randint(-mag, mag), rnd.randint(1, mag)
        rows.append((n, d, scale))
    df = spark.createDataFrame(rows, "n long, d long, s int")
    ref = _round_half_up if mode == "half_up" else _round_half_even
    for scale in (0, 1, 2):
        got = df.where(f"s = {scale}").select("n", "d", round_ratio("n", "d", scale, mode).alias("r")).collect()
        assert got
        for r in got:
            assert r.r == float(ref(Fraction(r.n, r.d), scale)), (r, scale, mode)
