"""Common table expressions of the SQL oracles, in the order in which they build on each other."""

from __future__ import annotations

from tidemark.plans.adapters import BARS_SQL

LN5 = "ln(5)"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} > 0 AND {b} > 0 THEN ln({a} / {b}) END"


def masked(a: str, b: str) -> str:
    return f"CASE WHEN {a} > 0 AND {b} > 0 AND abs(ln({a} / {b})) <= {LN5} THEN ln({a} / {b}) END"


def half_up(x: str, d: int) -> str:
    s = f"{10**d}.0::DOUBLE"
    return f"(CASE WHEN ({x}) * {s} >= 0 THEN floor(({x}) * {s} + 0.5) / {s} ELSE ceil(({x}) * {s} - 0.5) / {s} END)"


def tick(x: str) -> str:
    return f"(CASE WHEN {x} <= 0 THEN NULL WHEN {x} < 10 THEN 0.01::DOUBLE WHEN {x} < 50 THEN 0.05::DOUBLE WHEN {x} < 100 THEN 0.1::DOUBLE WHEN {x} < 500 THEN 0.5::DOUBLE WHEN {x} < 1000 THEN 1::DOUBLE ELSE 5::DOUBLE END)"


def limit(x: str, r: str) -> str:
    raw = f"({x} * {r}::DOUBLE)"
    return half_up(f"floor({raw} / {tick(raw)} + 1e-12) * {tick(raw)}", 2)


LAGS = """
lagged AS (
  SELECT *, "Trading_Volume" AS v, lag(open) OVER s AS lo, lag("max") OVER s AS lh, lag("min") OVER s AS ll, lag(close) OVER s AS lc,
    lag("Trading_Volume") OVER s AS lv, lead(adjclose) OVER s AS np, greatest("max" - "min", 0) + 1e-8 AS span
  FROM bars WINDOW s AS (PARTITION BY symbol ORDER BY date)
)"""

FEATS = f"""
feats0 AS (
  SELECT symbol, date, open, "max", "min", close, adjclose, v AS "Trading_Volume",
    {masked("open", "lo")} AS open_logret_1d, {masked('"max"', "lh")} AS max_logret_1d, {masked('"min"', "ll")} AS min_logret_1d, {masked("close", "lc")} AS close_logret_1d,
    {ratio("v", "lv")} AS trading_volume_logret_1d, abs(close - open) / span AS body_ratio, (close - open) / span AS signed_body_ratio, (close - "min") / span AS clv,
    ("max" - greatest(open, close)) / span AS upper_shadow, (least(open, close) - "min") / span AS lower_shadow,
    {ratio("close", "open")} AS intraday_return_co, {ratio("open", "lc")} AS overnight_gap_oc, {ratio('"max"', '"min"')} AS intraday_range,
    {masked("np", "adjclose")} AS return_1d, close IS NOT NULL AS alive, close IS NOT NULL AND (v IS NULL OR v > 0) AS tradable, lc
  FROM lagged
), feats AS MATERIALIZED (
  SELECT *, sign(intraday_return_co) * trading_volume_logret_1d AS signed_vol, body_ratio - lag(body_ratio) OVER s AS delta_body_ratio, clv - 0.5 AS clv_centered,
    clv - lag(clv) OVER s AS delta_clv, upper_shadow - lower_shadow AS shadow_imbalance
  FROM feats0 WINDOW s AS (PARTITION BY symbol ORDER BY date)
)"""

MASKS = f"""
refs AS (SELECT *, CASE WHEN lc > 0 THEN {half_up("lc", 2)} END AS reference FROM feats),
masks AS MATERIALIZED (
  SELECT *, tradable AND NOT coalesce(close >= {limit("reference", "1.1")} - 1e-9, false) AS can_buy,
    tradable AND NOT coalesce(close <= {limit("reference", "0.9")} + 1e-9, false) AS can_sell
  FROM refs
)"""

BOOK = """
ranked AS (
  SELECT date, symbol, row_number() OVER (PARTITION BY date ORDER BY close_logret_1d DESC, symbol DESC) AS r
  FROM feats WHERE tradable AND close_logret_1d IS NOT NULL
), runs AS (SELECT * FROM (VALUES ('top3', 3), ('top5', 5), ('top10', 10)) t(run_id, k)),
picks AS (SELECT run_id, date, symbol, 1.0::DOUBLE / count(*) OVER (PARTITION BY run_id, date) AS weight FROM ranked JOIN runs ON r <= k),
book AS MATERIALIZED (
  SELECT g.run_id, g.date, g.symbol, coalesce(p.weight, 0.0) AS weight, f.return_1d, coalesce(f.tradable, false) AS tradable, f.close_logret_1d AS score
  FROM (SELECT run_id, date, symbol FROM runs, (SELECT DISTINCT date FROM bars), (SELECT DISTINCT symbol FROM bars)) g
  LEFT JOIN picks p USING (run_id, date, symbol) LEFT JOIN feats f USING (date, symbol)
)"""

DAILY = """
moves AS (SELECT *, weight - lag(weight, 1, 0.0) OVER (PARTITION BY run_id, symbol ORDER BY date) AS d FROM book),
daily0 AS (
  SELECT run_id, date, sum(weight * coalesce(return_1d, 0)) AS gross_return, sum(greatest(d, 0)) AS buy_turnover, sum(greatest(-d, 0)) AS sell_turnover FROM moves GROUP BY ALL
), bench AS (SELECT date, coalesce(avg(return_1d), 0.0) AS benchmark_return FROM feats GROUP BY date),
daily AS MATERIALIZED (
  SELECT d.*, gross_return - 0.001 * buy_turnover - 0.003 * sell_turnover AS strategy_return, buy_turnover + sell_turnover AS turnover, benchmark_return FROM daily0 d JOIN bench USING (date)
)"""


def metrics(by: str, epsilon: str = "0", source: str = "daily") -> str:
    """SELECT of the performance figures of `daily`, grouped by `by`."""

    def over(mean: str, spread: str) -> str:
        return f"CASE WHEN {spread} + {epsilon} > 0 THEN {mean} / ({spread} + {epsilon}) * sqrt(252) ELSE 0 END"

    low = lambda c: f"sqrt(avg(pow(least({c}, 0), 2)))"
    return f"""
SELECT *, CASE WHEN max_drawdown < 0 THEN annualized_return / abs(max_drawdown) ELSE 0 END AS calmar, cumulative_return - cumulative_benchmark AS excess FROM (
  SELECT {by}, count(*) AS days, exp(sum(r)) - 1 AS cumulative_return, exp(avg(r) * 252) - 1 AS annualized_return, exp(avg(r) * 252) - 1 AS cagr,
    {over("avg(r)", "stddev_pop(r)")} AS sharpe, {over("avg(b)", "stddev_pop(b)")} AS sharpe_baseline, {over("avg(r)", low("r"))} AS sortino, {over("avg(b)", low("b"))} AS sortino_baseline,
    min(exp(c - peak) - 1) AS max_drawdown, avg(turnover) AS mean_turnover, avg((r > 0)::INT) AS hit_rate, exp(sum(b)) - 1 AS cumulative_benchmark
  FROM (SELECT *, max(c) OVER (PARTITION BY {by} ORDER BY date) AS peak FROM (
    SELECT *, sum(strategy_return) OVER (PARTITION BY {by} ORDER BY date) AS c, strategy_return AS r, benchmark_return AS b FROM (SELECT *, year(date)::INT AS year FROM {source})))
  GROUP BY {by})"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


PANEL = (BARS_SQL, LAGS, FEATS)
FULL = (*PANEL, BOOK, DAILY)
