"""Worked values of the price rules."""

import math
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import expressions as X
from tidemark.operators import features as P


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_round_half_up(spark):
    got = values(spark, [(1.005,), (2.675,), (-1.5,), (float("nan"),), (float("inf"),)], "x double", X.round_half_up(F.col("x"), 2))
    assert [g[0] for g in got] == [1.0, 2.68, -1.5, None, None]


def test_prices_beyond_longs(spark):
    """A reference divided by many reverse splits is rounded as a double; a long would end at 9.2e18."""
    up, down = X.limit_price(F.col("x"), 1.1), X.limit_price(F.col("x"), 0.9)
    got = values(spark, [(99.5 * 2.0**60,), (-99.5 * 2.0**60,), (2.0**70,)], "x double", X.round_half_up(F.col("x"), 2), up, down)
    for x, row in zip((99.5 * 2.0**60, -99.5 * 2.0**60, 2.0**70), got):
        assert row[0] == pytest.approx(x, rel=1e-12)
        if x > 0:
            assert row[1:] == (pytest.approx(1.1 * x, rel=1e-12), pytest.approx(0.9 * x, rel=1e-12))
    (zero,) = values(spark, [(-0.001,)], "x double", X.round_half_up(F.col("x"), 2))[0]
    assert zero == 0 and math.copysign(1, zero) == 1


def test_limit_prices(spark):
    closes = [9.95, 10, 49.8, 50, 99.9, 100, 499, 500, 999, 1000]
    got = values(spark, [(float(c),) for c in closes], "x double", X.limit_price(F.col("x"), 1.1), X.limit_price(F.col("x"), 0.9))
    assert [g[0] for g in got] == [10.9, 11, 54.7, 55, 109.5, 110, 548, 550, 1095, 1100]
    assert [g[1] for g in got] == [8.95, 9, 44.8, 45, 89.9, 90, 449, 450, 899, 900]


def test_decimals_and_groups(spark):
    got = values(spark, [("2330",), ("BTCUSD",)], "s string", X.price_decimals(F.col("s")), X.is_usd_pair(F.col("s")), X.is_exchange_code(F.col("s")))
    assert got == [(2, False, True), (8, True, False)]


def test_times_and_weekdays(spark):
    got = values(spark, [("2024-01-08 10:00:00",), ("nonsense",)], "s string", X.bar_time(F.col("s")), X.previous_weekday(F.to_date(X.bar_time(F.col("s")))))
    assert got[0] == (dt.datetime(2024, 1, 8, 10), dt.date(2024, 1, 8))
    assert got[1] == (None, None)
    days = values(spark, [(dt.date(2024, 1, 5 + i),) for i in range(4)], "d date", X.previous_weekday(F.col("d")))
    assert [d for d, in days] == [dt.date(2024, 1, 5)] * 3 + [dt.date(2024, 1, 8)]


def test_feature_groups(spark):
    names = ["close_logret_1d", "RET_5", "trading_volume_z", "signed_body_ratio", "upper_shadow", "intraday_range", "age"]
    got = values(spark, [(n,) for n in names], "n string", X.feature_group(F.col("n")), X.feature_label(F.col("n")))
    assert [g for g, _ in got] == ["Return", "Return", "Volume", "Candlestick", "Shadow", "Position", "Other"]
    assert got[0][1] == "Return / close_logret_1d"


def test_expm1_bounds(spark):
    got = values(spark, [(800.0,), (-800.0,), (0.5,)], "x double", X.safe_expm1(F.col("x")))
    assert got[0][0] == math.inf and got[1][0] == -1.0 and got[2][0] == pytest.approx(math.expm1(0.5))


def bars(spark, closes, **extra):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(i), "S", c, c, c, c, 1000.0, *(v[i] for v in extra.values())) for i, c in enumerate(closes)]
    names = "date date, symbol string, open double, max double, min double, close double, Trading_Volume double" + "".join(f", `{k}` double" for k in extra)
    return spark.createDataFrame(rows, names)


def test_limit_masks(spark):
    got = P.limit_masks(P.features(bars(spark, [100.0, 110.0, 90.0]))).orderBy("date").select("can_buy", "can_sell").collect()
    assert [tuple(r) for r in got] == [(True, True), (False, True), (True, False)]


def test_limit_masks_after_dividend_and_split(spark):
    got = P.limit_masks(P.features(bars(spark, [35.1, 37.5], Dividends=[0.0, 1.0]))).orderBy("date").collect()
    assert got[1]["can_buy"] is False
    got = P.limit_masks(P.features(bars(spark, [100.0, 55.0], **{"Stock Splits": [0.0, 2.0]}))).orderBy("date").collect()
    assert got[1]["can_buy"] is False


def test_extreme_labels_are_masked(spark):
    got = [r["return_1d"] for r in P.features(bars(spark, [0.09, 5500.0, 0.08, 0.081])).orderBy("date").collect()]
    assert got[:2] == [None, None] and got[2] == pytest.approx(math.log(0.081 / 0.08)) and got[3] is None


def test_labels_follow_adjclose(spark):
    got = P.features(bars(spark, [100.0, 110.0, 120.0], adjclose=[100.0, 105.0, 105.0])).orderBy("date").collect()
    assert got[0]["return_1d"] == pytest.approx(math.log(1.05)) and got[1]["return_1d"] == 0
    assert got[1]["close_logret_1d"] == pytest.approx(math.log(1.1))


def test_volume_policy(spark):
    no_volume = bars(spark, [1.0]).drop("Trading_Volume")
    with pytest.raises(ValueError):
        P.volume_policy(no_volume, "auto", "stock")
    assert P.volume_policy(no_volume, "auto", "fx") is False
    assert P.features(no_volume).select("tradable").first()[0] is True
