"""Integer half-away-from-zero rounding against Python's Decimal."""

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from fieldlake.functions.exact import div_half_up, from_units, money_avg, money_sum, ratio, sum_units


def test_div_half_up(spark):
    pairs = [(5, 2), (-5, 2), (7, 3), (-7, 3), (1, 3), (2, 3), (10**15 + 1, 2), (0, 5)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(div_half_up(F.col("n"), F.col("d"))).collect()]
    want = [int((Decimal(n) / Decimal(d)).quantize(Decimal(1), rounding=ROUND_HALF_UP)) for n, d in pairs]
    assert got == want


def test_money_aggregates_are_order_independent(spark):
    vals = [1.005, 2.675, 0.1, 0.2, 0.3, 1234.56]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.agg(money_sum(F.col("x")), money_avg(F.col("x"))).first()
    b = df.repartition(3).agg(money_sum(F.col("x")), money_avg(F.col("x"))).first()
    assert tuple(a) == tuple(b)
    total = sum(Decimal(str(v)) for v in vals)
    assert a[0] == float(total.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def test_sums_are_rounded_once(spark):
    df = spark.range(1000).select(F.lit(0.0625).alias("q"), F.lit(0.004).alias("m"))
    got = df.agg(from_units(sum_units(F.col("q"), 3), 3), money_sum(F.col("m"))).first()
    assert tuple(got) == (62.5, 4.0)


def test_averages_are_rounded_once(spark):
    got = lambda *v: spark.createDataFrame([(x,) for x in v], "x double").agg(money_avg(F.col("x"))).first()[0]
    assert got(0.004, 0.005) == 0.0 and got(0.005, 0.005) == 0.01 and got(-0.005, None) == -0.01
    assert got(1e15, 0.01) == 500000000000000.0 and got(None) is None
    r = spark.createDataFrame([(1, 3), (-1, 3), (1, 0), (None, 3)], "n long, d long")
    assert [x[0] for x in r.select(ratio(F.col("n"), F.col("d"))).collect()] == [0.33, -0.33, None, None]
