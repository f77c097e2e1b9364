"""Graph operators on small graphs with known answers, curves and folds."""

import collections
import os

import duckdb
import pytest

from tidemark.operators import attribution as A
from tidemark.operators import graph as G
from tidemark.plans import registry
from tidemark.plans.queries import QUERIES, panel

SF = "/root/testdata/sf0.001"


def edges(spark, pairs):
    return spark.createDataFrame([(a, b, float(w)) for a, b, w in pairs], "source string, target string, weight double")


TRIANGLE = [("a", "b", 1), ("b", "c", 1), ("c", "a", 1), ("c", "d", 1), ("e", "f", 1)]


def test_components(spark):
    weak = {r.node: r.component for r in G.weak_components(edges(spark, TRIANGLE)).collect()}
    assert weak == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e", "f": "e"}
    strong = {r.node: r.component for r in G.strong_components(edges(spark, TRIANGLE)).collect()}
    assert strong == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e", "f": "f"}


def test_triangles_and_cores(spark):
    assert {r.node: r.triangles for r in G.triangle_count(edges(spark, TRIANGLE)).collect()} == {"a": 1, "b": 1, "c": 1, "d": 0, "e": 0, "f": 0}
    assert {r.node: r.core for r in G.core_number(edges(spark, TRIANGLE)).collect()} == {"a": 2, "b": 2, "c": 2, "d": 1, "e": 1, "f": 1}


def shuffled_rows(df):
    """Rows that the exchanges of a table's plan write, once it has run."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "Exchange":
            total += p.metrics().apply("shuffleRecordsWritten").value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        todo += [p.executedPlan()] if name == "AdaptiveSparkPlan" else [p.plan()] if name.endswith("QueryStage") else []
    return total


def test_triangles_shuffle_no_wedges(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = [(f"a{i}", f"b{j}", 1) for i in range(40) for j in range(40)]  # 31,200 wedges or more, no triangle
        got = G.triangle_count(edges(spark, [*pairs, ("c", "c", 1), ("a0", "a1", 1)]))
        assert shuffled_rows(got) < 5 * len(pairs)
        want = {"c": 0} | {f"a{i}": 40 if i < 2 else 0 for i in range(40)} | {f"b{j}": 1 for j in range(40)}
        assert {r.node: r.triangles for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_triangles_free_the_disk(spark, monkeypatch):
    """Classes of nodes give whole counts, and neither shuffle files nor tables of steps are left."""
    import itertools
    import pathlib
    import random
    import time

    root = spark.conf.get("spark.checkpoint.dir")
    dirs = [pathlib.Path(str(d)) for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {f.name.split("_")[1] for d in dirs for f in d.glob("*/shuffle_*")}
    tables = lambda: {p.name for p in pathlib.Path(root).glob("*")}
    rng = random.Random(9)
    links = [(int(60 * rng.random() ** 2), rng.randrange(60)) for _ in range(900)]
    near = {n: {b for a, b in links + [(b, a) for a, b in links] if a == n and b != n} for p in links for n in p}
    want = {n: sum(m in near[k] for k, m in itertools.combinations(near[n], 2)) for n in near}
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(G, "CLASS_EDGES", 200, raising=False)
    try:
        shuffled, written = shuffles(), tables()
        got = G.triangle_count(edges(spark, [(f"n{a}", f"n{b}", 1) for a, b in links]))
        until = time.time() + 30
        while shuffles() - shuffled and time.time() < until:
            time.sleep(0.5)
        assert not shuffles() - shuffled
        assert not [t for t in tables() - written if t.startswith("triangles") and any(pathlib.Path(root, t).rglob("*.parquet"))]
        assert {int(r.node[1:]): r.triangles for r in got.collect()} == want and sum(want.values()) > 1000
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)


def test_core_number_by_peeling(spark):
    import random

    rng = random.Random(5)
    pairs = {(a, b) for a, b in ((int(40 * rng.random() ** 2), rng.randrange(40)) for _ in range(220)) if a != b} | {(99, 99)}
    near = {n: {b for a, b in pairs | {(b, a) for a, b in pairs} if a == n and b != n} for p in pairs for n in p}
    want, k = {}, 0
    while near:
        low = [n for n in near if len(near[n]) <= k]
        k += not low
        for n in low:
            want[n] = k
            for m in near.pop(n):
                near[m].discard(n)
    got = G.core_number(edges(spark, [(str(a), str(b), 1) for a, b in sorted(pairs)])).collect()
    assert {int(r.node): r.core for r in got} == want and max(want.values()) > 3
    assert G.core_number(edges(spark, TRIANGLE).limit(0)).count() == 0


def test_pagerank_sums_to_one(spark):
    got = {r.node: r["rank"] for r in G.pagerank(edges(spark, [("a", "b", 1), ("b", "a", 1), ("c", "a", 1)])).collect()}
    assert sum(got.values()) == pytest.approx(1) and got["a"] > got["b"] > got["c"]
    assert got["c"] == pytest.approx(0.05, abs=1e-6)


def test_roles_and_dominant_shock(spark):
    rows = [("x", "a", "b", 2.0), ("y", "a", "b", 2.0), ("y", "b", "c", 1.0)]
    got = {(r.source, r.target): r.dominant_shock for r in G.aggregate_edges(spark.createDataFrame(rows, "shock string, source string, target string, weight double")).collect()}
    assert got == {("a", "b"): "x", ("b", "c"): "y"}


def test_graph_rounds_raise_instead_of_ending_early(spark):
    path = edges(spark, [(f"n{i:02d}", f"n{i + 1:02d}", 1) for i in range(19)])
    assert G.core_number(path).count() == 20
    with pytest.raises(RuntimeError):
        G.core_number(path, rounds=4)
    ring = edges(spark, [(f"r{i}", f"r{(i + 1) % 8}", 1) for i in range(8)])
    assert {r.component for r in G.strong_components(ring).collect()} == {"r0"}
    with pytest.raises(RuntimeError):
        G.strong_components(ring, rounds=3)


def test_flows_read_the_order_lines_once(spark):
    plan = registry.QUERIES["q_compose_flow"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_suppkey" not in plan and "weight" in plan


def test_shocks_read_the_order_lines_once(spark):
    plan = registry.QUERIES["q_shock_edges"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_suppkey" not in plan and "close_logret_1d" in plan


def test_roles(spark):
    rows = [("a", 4.0, 0.0, 0.4, 0.0, 0.0, 0.1), ("b", 3.0, 1.0, 0.3, 0.1, 9.0, 0.1), ("c", 2.0, 3.0, 0.2, 0.3, 0.0, 0.5), ("d", 1.0, 1.0, 0.1, 0.1, 0.0, 0.1), ("e", 0.0, 5.0, 0.0, 0.5, 0.0, 0.2)]
    df = spark.createDataFrame(rows, "node string, out_degree double, in_degree double, hub_share double, authority_share double, betweenness double, pagerank double")
    plain = {r.node: r.role for r in G.assign_roles(df.drop("betweenness", "pagerank")).collect()}
    assert plain == {"a": "transmitter", "b": "transmitter", "c": "receiver", "d": "balanced", "e": "receiver"}
    full = {r.node: r.role for r in G.assign_roles(df).collect()}
    assert full == {"a": "transmitter", "b": "bridge", "c": "systemic_receiver", "d": "balanced", "e": "systemic_receiver"}


def test_shocked_features():
    names = ["close_logret_1d", "overnight_gap_oc", "max_logret_1d", "signed_vol", "upper_shadow", "clv"]
    assert A.shocked_features(names, "momentum") == ["close_logret_1d", "max_logret_1d"]
    assert A.shocked_features(names, "gap") == ["overnight_gap_oc", "max_logret_1d"]
    assert A.shocked_features(names, "zero") == names and A.shocked_features(names, "clv") == ["clv"]
    assert A.shocked_features(names, "volatility") == ["max_logret_1d", "upper_shadow", "clv"] and A.shocked_features(names, "liquidity") == []


def test_no_improve(spark):
    runs = {
        "plain": ([(1.0, None), (1.1, None), (None, None), (0.9, None), (0.95, None), (0.96, None)], 2),
        "nulls": ([(0.5, None), (None, None), (float("nan"), None), (0.6, None)], 1),
        "counter": ([(0.5, None), (0.6, 7), (0.7, None), (0.4, -1), (0.45, None)], 1),
        "goes on": ([(0.5, None), (None, 3), (0.7, None), (None, None), (0.8, None)], 5),
        "best of a counted one": ([(0.5, None), (0.3, 4), (0.4, None)], 5),
        "none": ([(None, None)], 0),
    }
    rows = [(run, i + 1, *x) for run, (xs, _) in runs.items() for i, x in enumerate(xs)] + [("plain", 0, 0.1, None)]
    df = spark.createDataFrame(rows, "run string, epoch int, val_mean double, counter int")
    assert {r.run: r.no_improve for r in A.no_improve_epochs(df, counter="counter").collect()} == {run: n for run, (_, n) in runs.items()}


def test_sample_dates(spark):
    df = spark.range(10).selectExpr("date_add(date'2024-01-01', int(id)) as date", "id")
    even = lambda n: sorted(r.id for r in A.sample_dates(df, "even", n).collect())
    assert [even(n) for n in (1, 2, 3, 4, 9, 10, 20)] == [[0], [0, 9], [0, 4, 9], [0, 3, 6, 9], [0, 1, 2, 3, 4, 5, 6, 7, 9], list(range(10)), list(range(10))]


def test_stability_flags(spark):
    df = spark.createDataFrame([(0.5, 0.1)], "max_weight double, turnover double")
    assert {r.rule: r.status for r in A.stability_flags(df).collect()} == {"max_weight": "warn", "turnover": "pass"}


def test_ridge_is_the_closed_form(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.standard_normal((200, 3))
    y = x @ [0.5, -1.0, 2.0] + rng.standard_normal(200) * 0.1
    rows = [(bool(True), float(t), *map(float, r)) for r, t in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, "tradable boolean, return_1d double, a double, b double, c double")
    model = A.ridge(A.training_matrix(df, ["a", "b", "c"]), 10.0)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 10.0 * np.eye(3), xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), want, atol=1e-6)


def test_attribution_fills_missing_shares(spark):
    a = spark.createDataFrame([("x", 0.5)], "feature string, share double")
    b = spark.createDataFrame([("y", 0.4)], "feature string, share double")
    got = {r.feature: r.mean_share for r in A.attribution_table({"one": a, "two": b}, ["feature"]).collect()}
    assert got == {"x": 0.25, "y": 0.2}


def reached(nodes, near):
    out = {}
    for n in nodes:
        seen, todo = {n}, [n]
        while todo:
            fresh = near[todo.pop()] - seen
            seen |= fresh
            todo += fresh
        out[n] = seen
    return out


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_graph_queries_take_all_order_lines(spark):
    lines = duckdb.sql(f"select distinct o_custkey * 3, l_suppkey * 3 + 1, l_partkey * 3 + 2, l_returnflag = 'R' from '{SF}/lineitem.parquet' join '{SF}/orders.parquet' on o_orderkey = l_orderkey").fetchall()
    got = lambda name, column: {r["node"]: r[column] for r in QUERIES[name](spark, SF).collect()}
    near, goods, meet = (collections.defaultdict(set) for _ in range(3))
    for c, s, p, back in lines:
        near[c].add(s), near[s].add(c), goods[s].add(c)
        if back:
            goods[c].add(s)
        for x, y in ((c, s), (c, p), (s, p)):
            meet[x].add(y), meet[y].add(x)
    assert got("q_weak_components", "component") == {n: min(r) for n, r in reached(near, near).items()}
    ways = reached(near, goods)
    assert got("q_strong_components", "component") == {n: min(m for m in r if n in ways[m]) for n, r in ways.items()}
    left, core, k = {n: set(r) for n, r in near.items()}, {}, 0
    while left:
        n = min(left, key=lambda n: len(left[n]))
        k = max(k, len(left[n]))
        core[n] = k
        for m in left.pop(n):
            left[m].discard(n)
    assert got("q_core_number", "core") == core
    assert got("q_trade_triangles", "triangles") == {n: sum(len(meet[n] & meet[m]) for m in meet[n]) // 2 for n in meet}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_shocks_take_all_symbols(spark):
    want = {r.symbol for r in panel(spark, SF).where("year(date) >= 2000").select("symbol").distinct().collect()}
    assert len(want) > 2 and {r.source for r in QUERIES["q_shock_edges"](spark, SF).select("source").distinct().collect()} == want


def test_fold_report_against_loops(spark):
    """Two folds: ridge by its normal equations, the best k, fees and rank correlations, by plain loops."""
    import datetime as dt
    import math

    import numpy as np

    from tidemark.operators import folds as W

    rng = np.random.default_rng(3)
    rows = []
    for year in (2020, 2021, 2022, 2023):
        for i in range(6):
            for s in range(4):
                x = rng.standard_normal(2)
                rows.append((dt.date(year, 3, 1 + i), f"S{s}", bool(rng.random() < 0.9), float(0.01 * x[0] + 0.01 * rng.standard_normal()), float(x[0]), float(x[1])))
    df = spark.createDataFrame(rows, "date date, symbol string, tradable boolean, return_1d double, a double, b double")
    folds = spark.createDataFrame([(0, 2021), (1, 2022)], "fold_id int, val_year int")
    got = {(r.fold_id, r.split): r for r in W.fold_report(W.fold_scores(df, folds, ["a", "b"]), 2, 0.001, 0.003).collect()}
    assert set(got) == {(0, "val"), (0, "test"), (1, "val"), (1, "test")}
    for (fold, split), r in got.items():
        year = 2021 + fold
        train = [x for x in rows if x[2] and x[0].year < year]
        m, y = np.array([x[4:] for x in train]), np.array([x[3] for x in train])
        coef = np.linalg.solve((m - m.mean(0)).T @ (m - m.mean(0)) + np.eye(2), (m - m.mean(0)).T @ (y - y.mean()))
        days, held, returns, ics = {}, {}, [], []
        for x in rows:
            if x[2] and ((x[0].year == year) if split == "val" else (x[0].year > year)):
                days.setdefault(x[0], []).append((float(np.array(x[4:]) @ coef), x[1], x[3]))
        for day in sorted(days):
            best = sorted(days[day], reverse=True)[:2]
            now = {s: 1 / len(best) for _, s, _ in best}
            moves = {s: now.get(s, 0) - held.get(s, 0) for s in {*now, *held}}
            returns.append(sum(now[s] * v for _, s, v in best) - 0.001 * sum(v for v in moves.values() if v > 0) + 0.003 * sum(v for v in moves.values() if v < 0))
            held = now
            by = lambda key: {s: i for i, (_, s) in enumerate(sorted((z[key], z[1]) for z in days[day]))}  # noqa: B023, E731
            one, two = by(0), by(2)
            n = len(one)
            ics.append(np.corrcoef([one[s] for s in one], [two[s] for s in one])[0, 1] if n >= 2 else 0.0)
        assert r.days == len(days) and r.cumulative_return == pytest.approx(math.expm1(sum(returns)), abs=1e-9) and r.ic_mean == pytest.approx(np.mean(ics), abs=1e-9)


def test_graph_iterations_against_plain_loops(spark):
    import random

    rng = random.Random(11)
    # three parts, with repeated edges, one-way chains and a node that has only a loop
    pairs = [(10 * rng.randrange(30) + k, 10 * rng.randrange(30) + k) for k in range(3) for _ in range(45)]
    pairs += pairs[:20] + [(999, 999)] + [(500 + i, 501 + i) for i in range(12)]
    ways = collections.defaultdict(set)
    for a, b in pairs:
        ways[a].add(b), ways[b]
    near = collections.defaultdict(set)
    for a, b in pairs:
        near[a].add(b), near[b].add(a)
    df = edges(spark, [(f"{a:03d}", f"{b:03d}", 1) for a, b in pairs])
    far, both = reached(ways, ways), reached(near, near)
    assert {int(r.node): int(r.component) for r in G.weak_components(df).collect()} == {n: min(r) for n, r in both.items()}
    assert {int(r.node): int(r.component) for r in G.strong_components(df).collect()} == {n: min(m for m in r if n in far[m]) for n, r in far.items()}
    assert {r.node: r.core for r in G.core_number(df).collect()}["999"] == 0


def written_tables(monkeypatch, run):
    """How many intermediate tables an operator on graphs writes, and their plans."""
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept(df)

    kept = G._cut
    monkeypatch.setattr(G, "_cut", noted)
    run().collect()
    return plans


@pytest.mark.parametrize("name", ["q_weak_components", "q_strong_components", "q_core_number"])
def test_graph_iterations_read_the_order_lines_once(spark, monkeypatch, name):
    plans = written_tables(monkeypatch, lambda: QUERIES[name](spark, SF))
    # the lines are gathered in one table, and no aggregate of links precedes it but the operator's own
    first = [p for p in plans if "l_suppkey" in p]
    assert len(first) == 1 and first[0].count("Aggregate") <= (name != "q_weak_components")
