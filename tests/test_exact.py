"""Exact rounding helpers agree with decimal arithmetic (half away from zero)."""
from decimal import ROUND_HALF_UP, Decimal


from churnlens.functions.exact import avg2, avg_money, index2, pct2, ratio4


def _round(n, d, scale):
    q = Decimal(n) / Decimal(d)
    return float(q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP))


def test_ratio_and_averages_match_decimal(spark):
    pairs = [(n, d) for d in (1, 2, 3, 7, 8, 57, 800, 1199) for n in range(-20, 60, 7)]
    pairs += [(57, 800), (1, 8), (5, 8), (3, 8), (1655, 3610), (0, 5)]
    df = spark.createDataFrame(pairs, "n long, d long")
    rows = df.select("n", "d", ratio4("n", "d").alias("r"), avg2("n", "d").alias("a"),
                     pct2("n", "d").alias("p"), avg_money("n", "d").alias("m")).collect()
    for r in rows:
        assert r.r == _round(r.n, r.d, 4), r
        assert r.a == _round(r.n, r.d, 2), r
        assert r.p == _round(r.n * 100, r.d, 2), r
        assert r.m == _round(r.n, r.d, 0) / 100, r


def test_zero_denominator_is_null_not_error(spark):
    df = spark.createDataFrame([(3, 0)], "n long, d long")
    r = df.select(ratio4("n", "d").alias("r"), avg2("n", "d").alias("a")).first()
    assert r.r is None and r.a is None


def test_churn_index_is_one_integer_ratio(spark):
    # (a/b)/(A/B) with a=1655, b=3610, A=1869, B=7043 → 1.73 (reference anchor arithmetic)
    df = spark.createDataFrame([(1655, 3610, 1869, 7043)], "a long, b long, ta long, tb long")
    r = df.select(index2("a", "b", "ta", "tb").alias("i")).first()
    assert r.i == _round(1655 * 7043, 3610 * 1869, 2)


def test_reference_anchor_rate(spark):
    df = spark.createDataFrame([(1655, 3610), (1869, 7043)], "n long, d long")
    got = [r.r for r in df.select(ratio4("n", "d").alias("r")).collect()]
    assert got == [0.4584, 0.2654]


def test_large_values_do_not_overflow(spark):
    # revenue in cents near 3e14 × 20000 exceeds BIGINT; the helpers widen first
    df = spark.createDataFrame([(300_000_000_000_000, 700_000_000_000_000)], "n long, d long")
    r = df.select(ratio4("n", "d").alias("r")).first()
    assert r.r == 0.4286
