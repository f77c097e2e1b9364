"""Registered queries of shocks and of models on lagged features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scratch import cut
from tidemark.operators import attribution as A
from tidemark.operators import features as P
from tidemark.operators import folds as W
from tidemark.operators import graph as G
from tidemark.operators import lag_models as L
from tidemark.operators import portfolio as B
from tidemark.plans import sqlparts as S
from tidemark.plans.adapters import bars
from tidemark.plans.queries import FIGURES, MODEL, panel, query

#: What q_edge_metrics scores by, and the shocks that move it.
SCORED = ["close_logret_1d", "trading_volume_logret_1d", "intraday_range"]
SHOCKS = ["momentum", "volume", "volatility", "liquidity", "zero"]
SYMBOLS = [f"N{i}" for i in range(25)]

_Z = "coalesce(({0} - avg({0}) OVER {1}) / nullif(stddev_pop({0}) OVER {1}, 0), 0)"


def _score_sql(columns: dict[str, str], window: str) -> str:
    z = {n: _Z.format(c, window) for n, c in columns.items()}
    return f"{z['close_logret_1d']} - 0.25 * {z['trading_volume_logret_1d']} + 0.5 * {z['intraday_range']}"


def _moved_sql(n: str) -> str:
    marks = {s: n in A.shocked_features(SCORED, s) for s in SHOCKS}
    cases = [f"WHEN shock = '{s}' THEN {'0.0' if s == 'zero' else f'{n} - sd_{n}' if s == 'liquidity' else f'{n} + sd_{n}'}" for s, hit in marks.items() if hit]
    return f"CASE WHEN symbol = source THEN CASE {' '.join(cases)} ELSE {n} END ELSE {n} END AS {n}"


EDGE_FIGURES = "mean_abs_score_change mean_score_change mean_abs_weight_change mean_weight_change mean_rank_change flip_probability mean_return_effect reallocation residual"
_EDGE_SQL = S.with_(*S.PANEL) + f""", rows0 AS (
  SELECT date, symbol, return_1d, {', '.join(f'coalesce({n}, 0.0) AS {n}' for n in SCORED)} FROM feats WHERE tradable AND return_1d IS NOT NULL
), sds AS (SELECT {', '.join(f'coalesce(stddev_pop({n}), 0.0) AS sd_{n}' for n in SCORED)} FROM rows0),
base AS (
  SELECT *, tanh(score) AS x_b, sum(abs(tanh(score))) OVER (PARTITION BY date) AS total_b, row_number() OVER (PARTITION BY date ORDER BY score DESC, symbol) AS rank_b
  FROM (SELECT date, symbol, return_1d, {_score_sql({n: n for n in SCORED}, 'd')} AS score FROM rows0 WINDOW d AS (PARTITION BY date))
), moved AS (
  SELECT shock, source, date, symbol, {', '.join(map(_moved_sql, SCORED))}
  FROM rows0, sds, (SELECT unnest({SYMBOLS}) AS source), (SELECT unnest({SHOCKS}) AS shock)
), shocked AS (
  SELECT *, tanh(score) AS x FROM (SELECT shock, source, date, symbol, {_score_sql({n: n for n in SCORED}, 'd')} AS score FROM moved WINDOW d AS (PARTITION BY shock, source, date))
), cases AS (
  SELECT s.shock, s.source, s.symbol AS target, s.score, b.score AS score_b, b.return_1d, x, x_b, rank_b, total_b,
    row_number() OVER (PARTITION BY shock, source, date ORDER BY s.score DESC, symbol) AS rank, sum(abs(x)) OVER c AS total,
    total_b + coalesce(sum(CASE WHEN source = symbol THEN abs(x) - abs(x_b) END) OVER c, 0) AS alone
  FROM shocked s JOIN base b USING (date, symbol) WINDOW c AS (PARTITION BY shock, source, date)
), weights AS (
  SELECT *, x_b / greatest(total_b, 1e-12) AS weight_b, x / greatest(total, 1e-12) AS weight, CASE WHEN source = target THEN x ELSE x_b END / greatest(alone, 1e-12) AS weight_a FROM cases
)
--result SELECT shock, source, target, avg(abs(score - score_b)) AS mean_abs_score_change, avg(score - score_b) AS mean_score_change, avg(abs(weight - weight_b)) AS mean_abs_weight_change,
  avg(weight - weight_b) AS mean_weight_change, avg(abs(rank - rank_b)) AS mean_rank_change, avg((weight * weight_b < 0)::INT) AS flip_probability, avg((weight - weight_b) * return_1d) AS mean_return_effect,
  avg(abs(weight_a - weight_b)) AS reallocation, avg(abs(weight - weight_a)) AS residual, count(*) AS days
FROM weights GROUP BY shock, source, target"""


def scored(rows, *by):
    z = lambda n: A.day_zscore(n, *by)
    return rows.withColumn("score", z("close_logret_1d") - 0.25 * z("trading_volume_logret_1d") + 0.5 * z("intraday_range"))


@query(_EDGE_SQL, EDGE_FIGURES)
def q_edge_metrics(spark, d):
    """Every shock of every symbol, scored by standing within the day, so that one symbol's features move all scores."""
    x = panel(spark, d).fillna(0.0, SCORED).where("tradable and return_1d is not null").select("date", "symbol", "return_1d", *SCORED)
    base = scored(x).select("date", F.col("symbol").alias("target"), "score", "return_1d")
    moved = scored(A.shocked_rows(x, SCORED, SYMBOLS, SHOCKS), "shock", "source")
    return G.edge_metrics(base, moved.select("shock", "source", "date", F.col("symbol").alias("target"), "score"))


@query()
def q_shock_edges(spark, d):
    """The same of a ridge fitted before 2000, on its own and the day's mean features, over the years after."""
    x = panel(spark, d).fillna(0.0, MODEL)
    symbols = sorted(r.symbol for r in x.where("year(date) >= 2000").select("symbol").distinct().collect())
    inputs = [*MODEL, *(f"mean_{n}" for n in MODEL)]
    rows = x.where("tradable and return_1d is not null").select("date", "symbol", "tradable", "return_1d", *MODEL)
    model = A.ridge(A.training_matrix(A.with_day_means(rows.where("year(date) < 2000"), MODEL), inputs))
    test = rows.where("year(date) >= 2000")
    base = A.score_panel(model, A.training_matrix(A.with_day_means(test, MODEL), inputs)).select("date", F.col("symbol").alias("target"), "score", "return_1d")
    shocked = A.shock_scores(model, test, MODEL, symbols, ["momentum", "volatility"]).select("shock", "source", "date", F.col("symbol").alias("target"), "score")
    return G.validated_transmission(G.edge_metrics(base, shocked))


# ---- lagged features, all folds -------------------------------------------------

LENGTH = 20
_N, _L = list(P.FEATURES), LENGTH
_P = len(_N) * _L
_LAGS_SQL = S.with_(*S.PANEL).replace("WITH", "WITH RECURSIVE", 1) + f""", days AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS day FROM (SELECT DISTINCT date FROM bars)),
dense AS (
  SELECT d.date, d.day, s.symbol, coalesce(f.tradable, false) AS tradable, f.return_1d, [{', '.join(f'coalesce(f.{n}, 0.0)' for n in _N)}] AS v
  FROM days d CROSS JOIN (SELECT DISTINCT symbol FROM bars) s LEFT JOIN feats f USING (date, symbol)
), rows_x AS MATERIALIZED (
  SELECT * FROM (SELECT date, day, symbol, year(date) AS year, return_1d, tradable, flatten(list(v) OVER (PARTITION BY symbol ORDER BY date ROWS {_L - 1} PRECEDING)) AS x FROM dense)
  WHERE tradable AND return_1d IS NOT NULL AND day > {_L - 1}
), numbered AS (SELECT year, [1.0] || x || [return_1d] AS z, row_number() OVER () AS rid FROM rows_x),
cols AS MATERIALIZED (SELECT year, i, list(z[i] ORDER BY rid) AS c FROM numbered, range(1, {_P + 3}) t(i) GROUP BY year, i),
gram AS MATERIALIZED (SELECT a.year, a.i, b.i AS j, list_inner_product(a.c, b.c) AS s FROM cols a JOIN cols b ON a.year = b.year AND a.i <= b.i),
starts AS (SELECT year(date) AS year, min(day) AS first FROM days GROUP BY ALL),
folds AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY year) - 2 AS fold_id, year AS val_year, first AS val_from, lead(first) OVER (ORDER BY year) AS test_from FROM starts
  QUALIFY year > min(year) OVER () AND year < max(year) OVER ()
), total AS MATERIALIZED (SELECT fold_id, i, j, sum(s) AS s FROM gram JOIN folds ON year < val_year GROUP BY ALL),
mean AS (SELECT fold_id, j, s / first_value(s) OVER w AS m, first_value(s) OVER w AS n FROM total WHERE i = 1 WINDOW w AS (PARTITION BY fold_id ORDER BY j)),
centred AS (SELECT t.fold_id, t.i, t.j, t.s - a.n * a.m * b.m AS s FROM total t JOIN mean a ON a.fold_id = t.fold_id AND a.j = t.i JOIN mean b ON b.fold_id = t.fold_id AND b.j = t.j WHERE t.i > 1),
filled AS (SELECT fold_id, i, j, s FROM centred WHERE i < {_P + 2} UNION ALL SELECT fold_id, j, i, s FROM centred WHERE i < j AND j < {_P + 2}),
walk(fold_id, k, i, r) AS (
  SELECT fold_id, 1, i - 1, list(s + CASE WHEN i = j THEN 1.0 ELSE 0.0 END ORDER BY j) FROM filled GROUP BY fold_id, i
  UNION ALL
  SELECT fold_id, k + 1, i, CASE WHEN i = k THEN list_transform(r[2:], lambda x: x / r[1]) ELSE list_transform(list_zip(r[2:], pr[2:]), lambda z: z[1] - z[2] * (r[1] / pr[1])) END
  FROM (SELECT *, any_value(r) FILTER (i = k) OVER (PARTITION BY fold_id, k) AS pr FROM walk WHERE k <= {_P})
), solved AS MATERIALIZED (SELECT fold_id, i, r[1] AS b FROM walk WHERE k = {_P + 1}),
levels AS (SELECT s.fold_id, any_value(y.m) - sum(b * x.m) AS b0 FROM solved s JOIN mean x ON x.fold_id = s.fold_id AND x.j = s.i + 1 JOIN mean y ON y.fold_id = s.fold_id AND y.j = {_P + 2} GROUP BY s.fold_id),
models AS MATERIALIZED (SELECT fold_id, list(b ORDER BY i) AS b, any_value(b0) AS b0 FROM solved JOIN levels USING (fold_id) GROUP BY fold_id),
scored AS MATERIALIZED (
  SELECT fold_id, CASE WHEN year = val_year THEN 'val' ELSE 'test' END AS split, date, symbol, return_1d, x, b, b0 + list_inner_product(x, b) AS score
  FROM rows_x, folds JOIN models USING (fold_id) WHERE year >= val_year AND day - CASE WHEN year = val_year THEN val_from ELSE test_from END > {_L - 1}
)"""


def lag_folds(spark, d):
    """The panel's rows with lags, its folds and their ridge coefficients."""
    x = L.prepared(panel(spark, d), _N, _L)
    folds = cut(B.expanding_year_folds(bars(spark, d)))
    coefficients = L.fold_coefficients(spark, L.year_moments(x.where(F.col("day") > _L - 1)), folds, _N, _L)
    return x, folds, coefficients


def lag_scored(x, folds, coefficients):
    return L.lag_scores(L.in_split(x, folds, _L).where("split != 'train'"), coefficients, _N)


@query(_LAGS_SQL + f"--result SELECT fold_id::INT AS fold_id, ({_L - 1} - (i - 1) // {len(_N)})::INT AS lag, {_N}[1 + (i - 1) % {len(_N)}] AS feature, b AS coefficient, b0 AS intercept FROM solved JOIN levels USING (fold_id)", "coefficient intercept")
def q_lag_ridge(spark, d):
    """Ridge on 15 features of 20 days, for every fold."""
    return lag_folds(spark, d)[2]


@query()
def q_lag_elastic_net(spark, d):
    """Elastic net on the same matrix, for every fold."""
    x = L.prepared(panel(spark, d), _N, _L)
    moments = L.year_moments(x.where(F.col("day") > _L - 1))
    return L.fold_coefficients(spark, moments, B.expanding_year_folds(bars(spark, d)), _N, _L, 1e-4, 0.5)


@query(_LAGS_SQL + "--result SELECT fold_id::INT AS fold_id, split, date, symbol, return_1d, score FROM scored", "return_1d score")
def q_lag_scores(spark, d):
    """Scores of each fold's ridge on its validation and test years."""
    return lag_scored(*lag_folds(spark, d)).select("fold_id", "split", "date", "symbol", "return_1d", "score")


@query(
    _LAGS_SQL + f""", val_rows AS (SELECT fold_id, date, symbol, score, exp(score - max(score) OVER w) AS e, list_transform(list_zip(x, b), lambda z: z[1] * z[2]) AS lost FROM scored WHERE split = 'val' WINDOW w AS (PARTITION BY fold_id, date)),
    weighed AS (SELECT fold_id, date, score, e / sum(e) OVER (PARTITION BY fold_id, date) AS w, lost FROM val_rows),
    cells AS (SELECT fold_id, date, score, w, unnest(lost) AS p, unnest(range(1, {_P + 1})) AS i FROM weighed),
    moved AS (SELECT *, exp(score - p - max(score - p) OVER c) AS e FROM cells WINDOW c AS (PARTITION BY fold_id, date, i)),
    deltas AS (SELECT fold_id, i, abs(p) AS ds, abs(e / sum(e) OVER (PARTITION BY fold_id, date, i) - w) AS dw FROM moved)
    --result SELECT fold_id::INT AS fold_id, ({_L - 1} - (i - 1) // {len(_N)})::INT AS lag, {_N}[1 + (i - 1) % {len(_N)}] AS feature, avg(ds) AS score_abs_delta, avg(dw) AS weight_abs_delta FROM deltas GROUP BY fold_id, i""",
    "score_abs_delta weight_abs_delta",
)
def q_lag_importance(spark, d):
    """What each feature at each lag does to scores and weights in each fold's validation year."""
    x, folds, coefficients = lag_folds(spark, d)
    scored = lag_scored(x, folds, coefficients).where("split = 'val'")
    return L.cell_importance(scored, coefficients, _N, _L)


@query(
    _LAGS_SQL + """, runs AS (SELECT fold_id || '/' || split AS run_id, date, symbol, score, return_1d FROM scored),
    ranked AS (SELECT *, row_number() OVER (w ORDER BY score DESC, symbol DESC) AS p, count(*) OVER w AS n, row_number() OVER (w ORDER BY score, symbol) AS i, row_number() OVER (w ORDER BY return_1d, symbol) AS j FROM runs WINDOW w AS (PARTITION BY run_id, date)),
    grid AS (SELECT * FROM (SELECT DISTINCT run_id, date FROM runs) JOIN (SELECT DISTINCT run_id, symbol FROM runs) USING (run_id)),
    held AS (SELECT g.run_id, g.date, g.symbol, CASE WHEN p <= 5 THEN 1.0::DOUBLE / least(n, 5) ELSE 0.0 END AS weight, return_1d FROM grid g LEFT JOIN ranked USING (run_id, date, symbol)),
    moves AS (SELECT *, weight - lag(weight, 1, 0.0) OVER (PARTITION BY run_id, symbol ORDER BY date) AS d FROM held),
    bench AS (SELECT run_id, date, avg(return_1d) AS benchmark_return FROM runs GROUP BY ALL),
    daily AS MATERIALIZED (SELECT run_id, date, sum(weight * coalesce(return_1d, 0)) - 0.001 * sum(greatest(d, 0)) - 0.003 * sum(greatest(-d, 0)) AS strategy_return, sum(abs(d)) AS turnover, any_value(benchmark_return) AS benchmark_return FROM moves JOIN bench USING (run_id, date) GROUP BY run_id, date),
    figures AS (""" + S.metrics("run_id") + """),
    ics AS (SELECT run_id, date, CASE WHEN any_value(n) >= 2 THEN 1 - 6.0 * sum(pow(i - j, 2)) / (any_value(n) * (pow(any_value(n), 2) - 1)) ELSE 0 END AS ic FROM ranked GROUP BY run_id, date),
    ic AS (SELECT run_id, avg(ic) AS ic_mean, avg((ic > 0)::INT) AS ic_positive FROM ics GROUP BY run_id)
    --result SELECT split_part(run_id, '/', 1)::INT AS fold_id, split_part(run_id, '/', 2) AS split, figures.* EXCLUDE (run_id, cumulative_return, excess), ln(1 + cumulative_return) AS log_return, ic_mean, ic_positive FROM figures JOIN ic USING (run_id)""",
    " ".join(f for f in FIGURES.split() if f not in ("cumulative_return", "excess")) + " log_return ic_mean ic_positive",
)
def q_lag_report(spark, d):
    """Figures and rank correlation of each fold's ridge on lagged features, for its validation year and the years after."""
    out = W.fold_report(lag_scored(*lag_folds(spark, d)).select("fold_id", "split", "date", "symbol", "score", "return_1d"), 5, 0.001, 0.003)
    # an invented market's returns compound to numbers that no rounding can compare
    return out.withColumn("log_return", F.log1p("cumulative_return")).drop("cumulative_return", "excess")
