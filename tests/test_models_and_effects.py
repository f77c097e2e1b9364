"""Models on lagged features, shocks, folds along series and objectives against plain loops."""

import datetime as dt
import os
import random

import numpy as np
import pytest

from tidemark.operators import features as P
from tidemark.operators import graph as G
from tidemark.operators import lag_models as L
from tidemark.operators import portfolio as B
from tidemark.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
DAY = dt.date(2020, 12, 20)


def small_panel(days=60, symbols="ABCD", seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(days):
        for s in symbols:
            if rng.random() < 0.1:
                continue
            f = [None if rng.random() < 0.05 else float(x) for x in rng.standard_normal(2)]
            rows.append((DAY + dt.timedelta(days=i), s, *f, float(rng.standard_normal()) if rng.random() < 0.95 else None, bool(rng.random() < 0.9)))
    return rows


PANEL = "date date, symbol string, f double, g double, return_1d double, tradable boolean"


def dense(rows, length):
    """{(date, symbol): (day, x)} by plain loops."""
    dates, symbols = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    have = {(r[0], r[1]): [r[2] or 0.0, r[3] or 0.0] for r in rows}
    out = {}
    for i, date in enumerate(dates):
        for s in symbols:
            x = []
            for k in range(length - 1, -1, -1):
                x += have.get((dates[i - k], s), [0.0, 0.0]) if i >= k else [0.0, 0.0]
            out[date, s] = (i, x)
    return out


def test_lag_vectors_and_splits(spark):
    rows = small_panel()
    df = spark.createDataFrame(rows, PANEL)
    got = L.lag_vectors(df, ["f", "g"], 3)
    want = dense(rows, 3)
    assert {(r.date, r.symbol): (r.day, r.x) for r in got.collect()} == want
    # 12 days of 2020 and 48 of 2021: a window of 3 leaves out each split's first three days
    folds = spark.createDataFrame([(0, 2021)], "fold_id int, val_year int")
    split = L.in_split(got, folds, 3).groupBy("split").agg({"day": "min"}).collect()
    assert {r.split: r[1] for r in split} == {"train": 3, "val": 15}


@pytest.mark.parametrize("alpha", [0.5, 30.0])
def test_moments_give_least_squares(spark, alpha):
    rows = small_panel(80, seed=5)
    df = spark.createDataFrame(rows, PANEL).repartition(3)
    x = L.lag_vectors(df, ["f", "g"], 3)
    folds = spark.createDataFrame([(0, 2021)], "fold_id int, val_year int")
    got = L.fold_coefficients(spark, L.year_moments(x), folds, ["f", "g"], 3, alpha).collect()
    want = dense(rows, 3)
    use = [r for r in rows if r[0].year == 2020 and r[5] and r[4] is not None]
    a, y = np.array([want[r[0], r[1]][1] for r in use]), np.array([r[4] for r in use])
    ac, yc = a - a.mean(0), y - y.mean()
    b = np.linalg.solve(ac.T @ ac + alpha * np.eye(6), ac.T @ yc)
    named = {(2 - k // 2, "fg"[k % 2]): b[k] for k in range(6)}
    assert {(r.lag, r.feature): pytest.approx(r.coefficient, abs=1e-9) for r in got} == named
    assert got[0].intercept == pytest.approx(y.mean() - a.mean(0) @ b)
    # scores and the effect of single cells
    coefficients = spark.createDataFrame(got, L.COEFFICIENTS)
    scored = L.softmax_weights(L.lag_scores(L.in_split(x, folds, 3).where("split = 'val'"), coefficients, ["f", "g"]))
    cells = {(r.lag, r.feature): r for r in L.cell_importance(scored, coefficients, ["f", "g"], 3).collect()}
    days = {}
    for r in scored.where("tradable").collect():
        assert r.score == pytest.approx(got[0].intercept + np.dot(r.x, b))
        days.setdefault(r.date, []).append(r)
    n = sum(map(len, days.values()))
    for k in range(6):
        ds = dw = 0.0
        for members in days.values():
            s = np.array([m.score for m in members])
            t = s - b[k] * np.array([m.x[k] for m in members])
            w, v = np.exp(s) / np.exp(s).sum(), np.exp(t) / np.exp(t).sum()
            assert w == pytest.approx([m.weight for m in members])
            ds, dw = ds + np.abs(s - t).sum(), dw + np.abs(w - v).sum()
        cell = cells[2 - k // 2, "fg"[k % 2]]
        assert (cell.score_abs_delta, cell.weight_abs_delta) == pytest.approx((ds / n, dw / n))
    summary = L.importance_summary(L.cell_importance(scored, coefficients, ["f", "g"], 3)).collect()
    assert sum(r.weight_delta_share for r in summary) == pytest.approx(1)


def test_elastic_net_is_optimal():
    """The solution fulfils the optimality conditions, and has zeros."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 12))
    x[:, 5] = x[:, 4] + 0.01 * rng.standard_normal(300)
    y = x[:, :3] @ [1.0, -2.0, 0.5] + rng.standard_normal(300) * 0.1
    z = np.column_stack([x, y])
    z -= z.mean(0)
    for alpha, l1 in ((0.1, 0.5), (0.3, 1.0), (0.01, 0.1), (50.0, 0.5)):
        b = L.solve_elastic_net(z.T @ z, 300, alpha, l1)
        slope = z[:, :12].T @ (z[:, 12] - z[:, :12] @ b) / 300 - alpha * (1 - l1) * b
        assert np.abs(slope[b != 0] - alpha * l1 * np.sign(b[b != 0])).max(initial=0) < 1e-6
        assert (np.abs(slope[b == 0]) <= alpha * l1 + 1e-9).all()
    assert not b.any()


@pytest.mark.parametrize("block", [1, 4, 64])
def test_side_masks_in_blocks(spark, block):
    rng = random.Random(block)
    rows, want = [], {}
    for run in "xy":
        for s in "ABC":
            at = 0.0
            for i in range(50):
                w, up, down = rng.choice([None, 0.0, 0.2, 0.5, -0.3, 1.0]), rng.random() < 0.6, rng.choice([True, False, None])
                rows.append((run, DAY + dt.timedelta(days=i), s, w, up, down))
                target = w or 0.0
                at = target if (target > at and up) or (target < at and down) else at
                want[run, rows[-1][1], s] = at
    df = spark.createDataFrame(rows, "run_id string, date date, symbol string, weight double, can_buy boolean, can_sell boolean").repartition(3)
    assert {(r.run_id, r.date, r.symbol): r.weight for r in B.side_masks(df, block).collect()} == want
    assert B.side_masks(df.limit(0), block).count() == 0


@pytest.mark.parametrize("long_only", [False, True])
def test_edge_metrics_by_hand(spark, long_only):
    rng = np.random.default_rng(8)
    days, names = [DAY, DAY + dt.timedelta(days=1)], "ABC"
    base = {(d, t): (float(rng.standard_normal()), float(rng.standard_normal())) for d in days for t in names if (d, t) != (days[1], "C")}
    moved = {(s, d, t): v + (0.7 if s == t else 0.1) * (1 if s == "A" else -1) for s in "ABC" for (d, t), (v, _) in base.items()}
    b = spark.createDataFrame([(d, t, v, r) for (d, t), (v, r) in base.items()], "date date, target string, score double, return_1d double")
    m = spark.createDataFrame([("up", s, d, t, v) for (s, d, t), v in moved.items()], "shock string, source string, date date, target string, score double")
    x = lambda v: max(np.tanh(v), 0.0) if long_only else np.tanh(v)
    got = {(r.source, r.target): r for r in G.edge_metrics(b, m, long_only).collect()}
    for s in names:
        for t in names:
            parts = []
            for d in days:
                if (d, t) not in base:
                    continue
                day = [u for u in names if (d, u) in base]
                old, new = {u: base[d, u][0] for u in day}, {u: moved[s, d, u] for u in day}
                alone = {u: new[u] if u == s else old[u] for u in day}
                w = [x(v[t]) / max(sum(abs(x(v[u])) for u in day), 1e-12) for v in (old, new, alone)]
                rank = [sorted(day, key=lambda u, v=v: (-v[u], u)).index(t) for v in (old, new)]
                parts.append((abs(new[t] - old[t]), w[1] - w[0], abs(rank[1] - rank[0]), w[0] * w[1] < 0, (w[1] - w[0]) * base[d, t][1], abs(w[2] - w[0]), abs(w[1] - w[2])))
            r = got[s, t]
            mean = np.mean(np.array(parts, dtype=float), axis=0)
            assert (r.mean_abs_score_change, r.mean_weight_change, r.mean_rank_change, r.flip_probability, r.mean_return_effect, r.reallocation, r.residual) == pytest.approx(tuple(mean), abs=1e-12)
            assert r.days == len(parts)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_shocks_reach_other_symbols(spark):
    rows = QUERIES["q_shock_edges"](spark, SF).where("source != target").collect()
    assert len(rows) > 100 and all(r.mean_abs_weight_change > 0 and r.residual > 0 and r.reallocation > 0 for r in rows)


def test_events_add_up(spark):
    rows = [("A", DAY + dt.timedelta(days=i), 100.0, True) for i in range(3)]
    panel = spark.createDataFrame(rows, "symbol string, date date, close double, tradable boolean")
    at = rows[1][1]
    ev = [("A", at, "dividend", 1.5), ("A", at, "dividend", 2.5), ("A", at, "split", 2.0), ("A", at, "split", 0.0), ("A", at, "split", None), ("B", at, "split", 3.0), ("A", DAY - dt.timedelta(days=9), "dividend", 50.0)]
    events = spark.createDataFrame(ev, "symbol string, date date, kind string, value double")
    got = {r.date: r for r in P.limit_masks(P.with_events(panel, events)).collect()}
    assert [got[d].reference for d in sorted(got)] == [None, 48.0, 100.0] and not got[at].can_buy and got[at].can_sell
    none = P.limit_masks(P.with_events(panel, events.limit(0)))
    assert none.count() == 3 and none.where("Dividends is not null").count() == 0


def test_factor_objective_of_odd_books(spark):
    """Days without a tradable symbol, missing scores and weights, and one-day runs have defined terms."""
    rows = [("r", DAY + dt.timedelta(days=i), s, sc, w, ret, ok) for i, (sc, w, ret, ok) in enumerate([(0.5, 0.5, 0.01, True), (None, None, None, True), (float("nan"), 0.2, float("inf"), True), (1.0, 0.1, 0.2, False)]) for s in "AB"]
    rows += [("one", DAY, "A", 1.0, 1.0, 0.1, True)]
    df = spark.createDataFrame(rows, "run_id string, date date, symbol string, score double, weight double, return_1d double, tradable boolean")
    got = {r.run_id: r for r in B.factor_objective(df).collect()}
    assert set(got) == {"r", "one"} and all(v is not None and np.isfinite(v) for r in got.values() for v in list(r)[1:] if r.run_id == "r")
    assert got["one"].block_stability == 0 and got["one"].gross_exposure == 0 and got["one"].net_exposure == 1
