"""Book operators against plain loops."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import portfolio as B


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(123)
    out = []
    for run in ("a", "b"):
        for d in range(17):
            for s in range(9):
                out.append((run, dt.date(2024, 1, 1) + dt.timedelta(d), f"S{s}", rng.uniform(-0.2, 0.2), rng.gauss(0, 0.02), rng.random() < 0.8, rng.random() < 0.8, rng.random() < 0.8))
    return out


SCHEMA = "run_id string, date date, symbol string, weight double, return_1d double, tradable boolean, can_buy boolean, can_sell boolean"


def loop(rows, cap=None, long_only=False, gross_cap=1e9):
    held, out = {}, {}
    for run, date in sorted({(r[0], r[1]) for r in rows}):
        day = sorted((r for r in rows if r[:2] == (run, date)), key=lambda r: r[2])
        old = {r[2]: held.get((run, r[2]), 0.0) for r in day}
        move = {r[2]: r[3] - old[r[2]] for r in day}
        for r in day:
            m = move[r[2]]
            if (m > 0 and not r[6]) or (m < 0 and not r[7]):
                move[r[2]] = 0.0
        if long_only:
            move = {s: max(m, -old[s]) for s, m in move.items()}
            left = 1 - sum(old.values()) - sum(m for m in move.values() if m < 0)
            buys = sum(m for m in move.values() if m > 0)
            if buys > max(left, 0):
                move = {s: m * max(left, 0) / buys if m > 0 else m for s, m in move.items()}
        traded = sum(map(abs, move.values()))
        if cap is not None and traded > cap:
            move = {s: m * cap / traded for s, m in move.items()}
        for s in old:
            held[run, s] = out[run, date, s] = old[s] + move[s]
    return out


def test_side_masks(spark, rows):
    got = {(r.run_id, r.date, r.symbol): r.weight for r in B.side_masks(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = loop(rows)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("long_only", [False, True])
def test_constrained_replay(spark, rows, long_only):
    got = {(r.run_id, r.date, r.symbol): r.weight for r in B.constrained_replay(spark.createDataFrame(rows, SCHEMA).repartition(5), 0.65, long_only, 1e9).collect()}
    want = loop(rows, 0.65, long_only)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_replay_goes_on_from_end_weights(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    head, tail = df.where("date < '2024-01-09'"), df.where("date >= '2024-01-09'")
    first = B.constrained_replay(head, 0.65, True, 1e9)
    second = B.constrained_replay(tail, 0.65, True, 1e9, start=B.end_weights(first))
    got = {(r.run_id, r.date, r.symbol): r.weight for r in first.unionByName(second).collect()}
    want = loop(rows, 0.65, True)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    assert {r.symbol for r in B.end_weights(first).where("run_id = 'a'").collect()} == {f"S{s}" for s in range(9)}


def test_replay_equals_side_masks_when_no_cap_binds(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    a = {(r.run_id, r.date, r.symbol): r.weight for r in B.side_masks(df).collect()}
    b = {(r.run_id, r.date, r.symbol): r.weight for r in B.constrained_replay(df, 100.0, gross_cap=100.0).collect()}
    assert all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)
    check = B.constraint_check(B.side_masks(df), None, 100.0).collect()
    assert all(r.first_violation is None for r in check)


def test_metrics_survive_missing_and_infinite(spark):
    rows = [("r", dt.date(2024, 1, 1 + i), x, y, 0.1) for i, (x, y) in enumerate([(0.01, 0.0), (float("nan"), 0.01), (float("inf"), -0.01), (None, None), (-0.02, float("-inf"))])]
    got = B.performance_metrics(spark.createDataFrame(rows, "run_id string, date date, strategy_return double, benchmark_return double, turnover double")).first()
    assert got.days == 5 and got.hit_rate == pytest.approx(0.2) and got.max_drawdown == pytest.approx(-0.0198, abs=1e-4)


def test_permuted_input_gives_the_same_weights(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).where("run_id = 'a'").withColumn("score", F.round("weight", 2))
    a = B.top_k_equal_weight(df, "score", 3).orderBy("date", "symbol").collect()
    b = B.top_k_equal_weight(df.orderBy(F.rand(3)).repartition(7), "score", 3).orderBy("date", "symbol").collect()
    assert a == b


def test_exposure_summary_and_contribution(spark):
    """Two days by hand: S2 can't be traded on the second one."""
    a, b = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [("r", a, "S1", 0.5, 0.1, True, True, True), ("r", a, "S2", -0.5, 0.2, True, True, True), ("r", b, "S1", 0.2, 0.1, True, True, True), ("r", b, "S2", -0.4, 0.3, False, True, True)]
    df = spark.createDataFrame(rows, SCHEMA)
    one, two = B.portfolio_exposure(df).orderBy("date").collect()
    assert (one.turnover, one.active, one.gross, one.short) == (0.0, 2, 1.0, 0.5) and one.market_return == pytest.approx(0.15)
    assert two.turnover == pytest.approx(0.8) and two.gross == pytest.approx(0.2) and two.hhi == pytest.approx(1) and two.market_return == pytest.approx(0.1) and two.untradable_abs_weight == pytest.approx(0.4)
    s = B.portfolio_summary(df).first()
    assert s.mean_abs_net == pytest.approx(0.1) and s.mean_scaled_hhi == pytest.approx((0.5 * 2 + 0.2 * 1) / 2) and s.untradable_abs_weight_sum == pytest.approx(0.4) and s.mean_turnover_proxy == pytest.approx(0.4)
    c = {r.symbol: r for r in B.symbol_contribution(df).collect()}
    assert c["S2"].active_days == 1 and c["S2"].total_contribution == pytest.approx(-0.1) and c["S2"].mean_weight == pytest.approx(-0.45)


def test_policy_reward(spark):
    a, b = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [("r", a, "S1", -1.0, 0.1, True, True, True), ("r", a, "S2", 0.0, 0.2, True, True, True), ("r", a, "S3", 5.0, 0.4, False, True, True), ("r", b, "S1", 1.0, 0.1, True, True, True), ("r", b, "S2", -3.0, 0.2, True, True, True), ("r", b, "S3", 0.0, 0.4, True, True, True)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = B.policy_reward(df, 0.1).orderBy("date").collect()
    assert [r.gross_return for r in got] == pytest.approx([0.15, 0.1]) and [r.turnover for r in got] == pytest.approx([1.0, 1.0]) and got[0].reward == pytest.approx(0.05)
    both = B.policy_reward(df, long_only=False).orderBy("date").collect()
    assert [r.gross_return for r in both] == pytest.approx([-0.1, 0.25 * 0.1 - 0.75 * 0.2])


def test_stability_and_risk_of_short_series(spark):
    """Three days in eight blocks at most, by hand."""
    v, m = [0.01, -0.02, 0.03], [0.0, 0.01, -0.01]
    df = spark.createDataFrame([("r", dt.date(2024, 1, 1 + i), x, y, 0.1) for i, (x, y) in enumerate(zip(v, m, strict=True))], "run_id string, date date, strategy_return double, benchmark_return double, turnover double")
    mean = sum(v) / 3
    std = (sum((x - mean) ** 2 for x in v) / 3 + 1e-8) ** 0.5
    assert B.block_stability(df, "strategy_return").first().block_stability == pytest.approx(-mean + std + 0.02)
    # two blocks of two days: the last value fills the second
    two = [-0.005, 0.03]
    mean = sum(two) / 2
    assert B.block_stability(df, "strategy_return", 2).first().block_stability == pytest.approx(-mean + (sum((x - mean) ** 2 for x in two) / 2 + 1e-8) ** 0.5 + 0.005)
    assert B.block_stability(df.limit(1), "strategy_return").first().block_stability == 0
    risk = B.excess_risk(df).first()
    e = [math.exp(0.01), math.exp(-0.02), math.exp(0.02)]
    assert risk.relative_drawdown == pytest.approx(e[1] / e[0] - 1) and risk.penalty == pytest.approx(math.log1p(math.exp((1 - e[1] / e[0] - 0.2) * 20)) / 20)
