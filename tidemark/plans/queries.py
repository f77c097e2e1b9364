"""Registered queries of the panel operators, each with its SQL oracle where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions import expressions as X
from tidemark.functions.scratch import cut
from tidemark.operators import attribution as A
from tidemark.operators import cleaning as C
from tidemark.operators import features as P
from tidemark.operators import folds as W
from tidemark.operators import graph as G
from tidemark.operators import portfolio as B
from tidemark.operators import universe as U
from tidemark.plans import sqlparts as S
from tidemark.plans.adapters import bars, table
from tidemark.sources import files
from tidemark.streaming import bars as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six digits, so that the order of a sum doesn't show; no negative zero."""
    return df.select(*((F.round(F.col(f"`{f.name}`"), DIGITS) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`") for f in df.schema))


def query(sql: str | None = None, doubles: str = "", name: str | None = None):
    """Register a query; doubles: the columns of its oracle that are rounded."""

    def put(f):
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            # the last top-level SELECT becomes a subquery whose doubles are rounded
            head, _, body = sql.rpartition("--result")
            replace = f" REPLACE ({', '.join(f'round({c}::DOUBLE, {DIGITS}) + 0.0 AS {c}' for c in doubles.split())})" if doubles else ""
            ORACLES[key] = f"{head}\nSELECT *{replace} FROM ({body}) AS result"
        return f

    return put


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the daily bars, written once for all uses: a row per symbol and day, however many trades there are."""
    return cut(P.features(bars(spark, sf_dir)))


def momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, mask and score of the panel, written once for all that is derived from them."""
    return cut(P.features(bars(spark, sf_dir)).select("date", "symbol", "return_1d", "tradable", F.col("close_logret_1d").alias("score")))


def book_of(x: DataFrame) -> DataFrame:
    """Dense weights of three momentum books, with the panel's label and mask, from one ranking."""
    ok = x.where(F.col("tradable") & X.finite(F.col("score")).isNotNull())
    ranked = ok.withColumn("r", F.row_number().over(B.day_window().orderBy(F.desc("score"), F.desc("symbol")))).withColumn("n", F.count("*").over(B.day_window()))
    runs = F.array(*(F.struct(F.lit(f"top{k}").alias("run_id"), F.lit(k).alias("k")) for k in (3, 5, 10)))
    dense = B.align_panel(x).join(ranked.select("date", "symbol", "r", "n"), ["date", "symbol"], "left").withColumn("run", F.explode(runs))
    weight = F.when(F.col("r") <= F.col("run.k"), F.lit(1.0) / F.least("n", "run.k")).otherwise(0.0)
    return dense.select("run.run_id", "date", "symbol", "return_1d", F.coalesce("tradable", F.lit(False)).alias("tradable"), "score", weight.alias("weight"))


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book_of(momentum(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = momentum(spark, sf_dir)
    return B.portfolio_daily(book_of(x), 0.001, 0.003).join(B.universe_average(x), "date")


FIGURES = "cumulative_return annualized_return cagr sharpe sharpe_baseline sortino sortino_baseline max_drawdown mean_turnover hit_rate cumulative_benchmark calmar excess"
RAW = 'open "max" "min" close adjclose "Trading_Volume"'
ALL = " ".join(P.FEATURES) + " intraday_return_co overnight_gap_oc intraday_range return_1d"


# ---- bars, features, labels ------------------------------------------------


@query(S.with_(S.BARS_SQL) + '--result SELECT symbol, date, open, "max", "min", close, adjclose, "Trading_Volume" FROM bars', RAW)
def q_bars(spark, d):
    return bars(spark, d).select("symbol", "date", "open", "max", "min", "close", "adjclose", "Trading_Volume")


@query(S.with_(*S.PANEL) + f"--result SELECT symbol, date, {', '.join(ALL.split())}, alive, tradable FROM feats", ALL)
def q_candle_features(spark, d):
    return panel(spark, d).select("symbol", "date", *ALL.split(), "alive", "tradable")


@query(S.with_(*S.PANEL) + f"--result SELECT symbol, date, {', '.join(f'coalesce({c}, 0.0) AS {c}' for c in P.FEATURES)}, return_1d FROM feats", " ".join(P.FEATURES) + " return_1d")
def q_fill_features(spark, d):
    return P.filled(panel(spark, d)).select("symbol", "date", *P.FEATURES, "return_1d")


@query(S.with_(*S.PANEL, S.MASKS) + "--result SELECT symbol, date, reference, can_buy, can_sell FROM masks", "reference")
def q_limit_masks(spark, d):
    return P.limit_masks(panel(spark, d)).select("symbol", "date", "reference", "can_buy", "can_sell")


_PX = "(l_extendedprice::DOUBLE / l_quantity::DOUBLE / 7)"


@query(
    f"WITH x AS (SELECT l_orderkey, {_PX} AS px FROM lineitem WHERE l_quantity > 0)--result SELECT l_orderkey, {S.half_up('px', 2)} AS r2, {S.half_up('-px', 1)} AS neg1, {S.tick('px')} AS tick, {S.limit('px', '1.1')} AS up, {S.limit('px', '0.9')} AS down, {S.masked('px', '100.0')} AS logret FROM x",
    "r2 neg1 tick up down logret",
)
def q_price_rules(spark, d):
    x = table(spark, d, "lineitem").where("l_quantity > 0").select("l_orderkey", (F.col("l_extendedprice").cast("double") / F.col("l_quantity").cast("double") / 7).alias("px"))
    px = F.col("px")
    return x.select("l_orderkey", X.round_half_up(px, 2).alias("r2"), X.round_half_up(-px, 1).alias("neg1"), X.tick_size(px).alias("tick"), X.limit_price(px, 1.1).alias("up"), X.limit_price(px, 0.9).alias("down"), X.log_return(px, F.lit(100.0)).alias("logret"))


@query(S.with_(*S.PANEL) + "--result SELECT count(*) AS rows, sum(coalesce(close_logret_1d, 0) + coalesce(clv, 0)) AS feature_sum, sum(return_1d) AS label_sum, count(*) FILTER (tradable) AS tradable FROM feats", "feature_sum label_sum")
def q_frame_checksum(spark, d):
    return C.frame_checksum(panel(spark, d), ["close_logret_1d", "clv"])


@query(
    S.with_(*S.PANEL) + """--result SELECT symbol, date, list_transform([lag(close_logret_1d, 2) OVER s, lag(close_logret_1d, 1) OVER s, close_logret_1d], lambda x: round(coalesce(x, 0), 6) + 0.0)::VARCHAR[]::VARCHAR AS last3
    FROM feats WINDOW s AS (PARTITION BY symbol ORDER BY date) QUALIFY row_number() OVER s >= 3"""
)
def q_lookback_window(spark, d):
    x = P.lag_columns(panel(spark, d), ["close_logret_1d"], 3)
    cell = lambda k: F.round(F.col(f"close_logret_1d__{k}"), 6) + F.lit(0.0)
    return x.select("symbol", "date", cell(0).alias("lag0"), cell(1).alias("lag1"), cell(2).alias("lag2"))


ORACLES["q_lookback_window"] = S.with_(*S.PANEL) + """
SELECT symbol, date, round(coalesce(close_logret_1d, 0), 6) + 0.0 AS lag0, round(coalesce(lag(close_logret_1d, 1) OVER s, 0), 6) + 0.0 AS lag1, round(coalesce(lag(close_logret_1d, 2) OVER s, 0), 6) + 0.0 AS lag2
FROM feats WINDOW s AS (PARTITION BY symbol ORDER BY date) QUALIFY row_number() OVER s >= 3"""


@query(S.with_(*S.PANEL) + """--result SELECT symbol, date, 5 AS length, sum(coalesce(close_logret_1d, 0) + coalesce(clv, 0)) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS total
    FROM feats QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date) >= 5""", 'total')
def q_window_arrays(spark, d):
    return P.lookback(panel(spark, d), ["close_logret_1d", "clv"], 5).select("symbol", "date", F.size("window").alias("length"), F.aggregate(F.flatten("window"), F.lit(0.0), lambda a, v: a + v).alias("total"))


# ---- cross-section ----------------------------------------------------------


@query(S.with_(*S.PANEL) + "--result SELECT date, coalesce(avg(return_1d), 0.0) AS benchmark_return, coalesce(sum(return_1d) FILTER (tradable), 0.0) AS total_return FROM feats GROUP BY date", "benchmark_return total_return")
def q_universe_returns(spark, d):
    x = panel(spark, d)
    return B.universe_average(x).join(B.universe_cumulative(x), "date")


@query(S.with_(*S.PANEL) + "--result SELECT date, symbol, row_number() OVER (PARTITION BY date ORDER BY close_logret_1d, symbol) AS r FROM feats WHERE close_logret_1d IS NOT NULL")
def q_cross_section_rank(spark, d):
    return B.cross_section_rank(panel(spark, d), "close_logret_1d", "r").where("r is not null").select("date", "symbol", "r")


@query(
    S.with_(*S.PANEL) + """, c AS (SELECT date, symbol, greatest(least(coalesce(clv_centered, 0.0), 20), -20) AS v FROM feats), m AS (SELECT *, avg(v) OVER w AS a, greatest(count(*) OVER w, 2) AS n FROM c WINDOW w AS (PARTITION BY date))
    --result SELECT date, symbol, (v - a) / (sqrt(sum(pow(v - a, 2)) OVER (PARTITION BY date) / n) + 1e-6) AS z FROM m""",
    "z",
)
def q_cross_section_zscore(spark, d):
    return B.cross_section_zscore(panel(spark, d), "clv_centered", "z").select("date", "symbol", "z")


@query(
    S.with_(*S.PANEL) + """, t AS (SELECT date, symbol, tanh(greatest(least(coalesce(shadow_imbalance, 0.0), 20), -20)) AS a, CASE WHEN tradable THEN tanh(greatest(coalesce(shadow_imbalance, 0.0), 0)) ELSE 0 END AS b,
      CASE WHEN tradable THEN exp(shadow_imbalance - max(CASE WHEN tradable THEN shadow_imbalance END) OVER (PARTITION BY date)) END AS e FROM feats)
    --result SELECT date, symbol, a / greatest(sum(abs(a)) OVER w, 1e-12) AS long_short, b / greatest(sum(abs(b)) OVER w, 1e-12) * 0.5 AS long_only, coalesce(e / sum(e) OVER w, 0.0) AS softmax FROM t WINDOW w AS (PARTITION BY date)""",
    "long_short long_only softmax",
)
def q_score_weights(spark, d):
    x = panel(spark, d)
    out = B.normalize_weights(x, "shadow_imbalance", False, bound=20.0).withColumnRenamed("weight", "long_short")
    out = B.normalize_weights(out, "shadow_imbalance", True, 0.5, F.col("tradable")).withColumnRenamed("weight", "long_only")
    return B.masked_softmax(out, "shadow_imbalance", F.col("tradable")).select("date", "symbol", "long_short", "long_only", F.col("weight").alias("softmax"))


@query(S.with_(*S.PANEL, S.BOOK) + "--result SELECT run_id, date, symbol, weight, tradable FROM book", "weight")
def q_top_k_books(spark, d):
    x = momentum(spark, d)
    picks = None
    for k in (3, 5, 10):
        part = B.top_k_equal_weight(x, "score", k).withColumn("run_id", F.lit(f"top{k}"))
        picks = part if picks is None else picks.unionByName(part)
    dense = B.align_panel(x).withColumn("run_id", F.explode(F.array(*map(F.lit, ("top3", "top5", "top10")))))
    out = dense.join(picks, ["run_id", "date", "symbol"], "left")
    return out.withColumns({"weight": F.coalesce("weight", F.lit(0.0)), "tradable": F.coalesce("tradable", F.lit(False))}).select("run_id", "date", "symbol", "weight", "tradable")


# ---- profit and loss, performance -------------------------------------------


@query(S.with_(*S.FULL) + "--result SELECT run_id, date, gross_return, buy_turnover, sell_turnover, strategy_return, turnover, benchmark_return FROM daily", "gross_return buy_turnover sell_turnover strategy_return turnover benchmark_return")
def q_daily_backtest(spark, d):
    return daily(spark, d).select("run_id", "date", "gross_return", "buy_turnover", "sell_turnover", "strategy_return", "turnover", "benchmark_return")


@query(S.with_(*S.FULL) + "--result " + S.metrics("run_id"), FIGURES)
def q_performance(spark, d):
    return B.performance_metrics(daily(spark, d))


@query(S.with_(*S.FULL) + "--result " + S.metrics("run_id, year", "1e-8"), FIGURES)
def q_momentum_by_year(spark, d):
    return B.metrics_by_year(daily(spark, d))


_CURVE = ", c AS (SELECT *, sum(strategy_return) OVER w AS c FROM daily WINDOW w AS (PARTITION BY run_id ORDER BY date)), p AS (SELECT *, max(c) OVER (PARTITION BY run_id ORDER BY date) AS peak FROM c)"


@query(S.with_(*S.FULL) + _CURVE + "--result SELECT run_id, date, exp(greatest(least(c, 60), -60)) AS equity, exp(c - peak) - 1 AS drawdown, exp(c - greatest(peak, 0)) - 1 AS drawdown_capital FROM p", "equity drawdown drawdown_capital")
def q_equity_and_drawdown(spark, d):
    x = B.equity_curve(daily(spark, d), "strategy_return")
    x = B.with_drawdown(x, "strategy_return")
    return B.with_drawdown(x, "strategy_return", "drawdown_capital", True).select("run_id", "date", "equity", "drawdown", "drawdown_capital")


@query(
    S.with_(*S.FULL) + _CURVE + """, low AS (SELECT run_id, arg_min(date, (exp(c - peak) - 1, date)) AS trough_date, min(exp(c - peak) - 1) AS depth FROM p GROUP BY run_id)
    --result SELECT run_id, (SELECT min(c.date) FROM c WHERE c.run_id = low.run_id AND c.date <= trough_date AND c.c = (SELECT max(x.c) FROM c x WHERE x.run_id = low.run_id AND x.date <= trough_date)) AS peak_date, trough_date, depth FROM low""",
    "depth",
)
def q_drawdown_segment(spark, d):
    return B.drawdown_segment(daily(spark, d), "strategy_return")


_OK = ", ok AS (SELECT date, symbol, shadow_imbalance AS s, return_1d AS r FROM feats WHERE tradable AND shadow_imbalance IS NOT NULL AND return_1d IS NOT NULL), rk AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY s, symbol)::DOUBLE AS rs, row_number() OVER (PARTITION BY date ORDER BY r, symbol)::DOUBLE AS rr FROM ok)"


def _corr(x: str, y: str) -> str:
    """Daily correlation of two columns of rk, in the order of operations of the operator."""
    return f"(SELECT date, CASE WHEN count(*) >= 2 THEN sum(x * y) / greatest(sqrt(sum(x * x) * sum(y * y)), 1e-8) ELSE 0 END AS c, count(*) AS n FROM (SELECT date, {x} - avg({x}) OVER (PARTITION BY date) AS x, {y} - avg({y}) OVER (PARTITION BY date) AS y FROM rk) GROUP BY date)"


_IC = _OK + f", days AS (SELECT DISTINCT date FROM feats), ic AS (SELECT d.date, coalesce(a.c, 0.0) AS ic, coalesce(b.c, 0.0) AS corr, coalesce(h.c, 0.0) AS half_rank_ic, coalesce(a.n, 0) AS n FROM days d LEFT JOIN {_corr('rs', 'rr')} a USING (date) LEFT JOIN {_corr('s', 'r')} b USING (date) LEFT JOIN {_corr('s', 'rr')} h USING (date))"


@query(S.with_(*S.PANEL) + _IC + "--result SELECT * FROM ic", "ic corr half_rank_ic")
def q_daily_ic(spark, d):
    x = panel(spark, d)
    out = B.daily_ic(x, "shadow_imbalance").join(B.daily_corr(x, "shadow_imbalance").drop("n"), "date")
    return out.join(B.half_rank_ic(x, "shadow_imbalance").drop("n"), "date").select("date", "ic", "corr", "half_rank_ic", "n")


@query(S.with_(*S.PANEL) + _IC + "--result SELECT count(ic) AS days, avg(ic) AS ic_mean, stddev_pop(ic) + 1e-8 AS ic_std, avg((ic > 0)::INT) AS ic_positive, avg(ic) / (stddev_pop(ic) + 1e-8) * sqrt(252) AS icir FROM ic", "ic_mean ic_std ic_positive icir")
def q_ic_summary(spark, d):
    return B.ic_summary(B.daily_ic(panel(spark, d), "shadow_imbalance"))


@query(
    S.with_(*S.PANEL) + """, k AS (SELECT date, symbol, greatest(least(coalesce(shadow_imbalance, 0.0), 20), -20) AS v, return_1d AS r FROM feats WHERE tradable AND return_1d IS NOT NULL),
    m AS (SELECT *, v - avg(v) OVER w AS c, r - avg(r) OVER w AS y, greatest(count(*) OVER w, 2) AS n FROM k WINDOW w AS (PARTITION BY date)),
    z AS (SELECT date, y, c / (sqrt(sum(c * c) OVER (PARTITION BY date) / n) + 1e-6) AS z FROM m), slopes AS (SELECT date, sum(z * y) / greatest(sum(z * z), 1e-6) AS slope FROM z GROUP BY date)
    --result SELECT avg(slope) AS mean_slope, avg(slope) / sqrt(var_pop(slope) + 1e-8) * sqrt(count(slope)) AS tstat FROM slopes""",
    "mean_slope tstat",
)
def q_fama_macbeth(spark, d):
    slopes = B.fama_macbeth_slope(panel(spark, d), "shadow_imbalance")
    return B.series_tstat(slopes, "slope").crossJoin(slopes.agg(F.avg("slope").alias("mean_slope"))).select("mean_slope", "tstat")


@query(
    S.with_(*S.FULL) + "--result SELECT run_id, avg(strategy_return) / sqrt(var_pop(strategy_return) + 1e-8) * sqrt(252) AS sharpe_ratio, avg(strategy_return) / sqrt(avg(pow(least(strategy_return, 0), 2)) + 1e-8) * sqrt(252) AS sortino_ratio, 252 * avg(strategy_return) AS log_utility FROM daily GROUP BY run_id",
    "sharpe_ratio sortino_ratio log_utility",
)
def q_risk_ratio(spark, d):
    return B.risk_ratio(daily(spark, d))


_SOFT = lambda x: f"(greatest({x}, 0) + ln(1 + exp(-abs({x}))))"


_REGIMES = f""", regime_means AS (SELECT run_id, CASE WHEN benchmark_return <= -0.002 THEN 'down' WHEN benchmark_return >= 0.002 THEN 'up' ELSE 'flat' END AS g, avg(strategy_return) AS m FROM daily GROUP BY ALL),
  regimes AS (SELECT run_id, CASE WHEN count(*) >= 2 THEN -avg(m) + sqrt(var_pop(m) + 1e-8) + {_SOFT("(-min(m))")} ELSE 0 END AS regime_stability FROM regime_means GROUP BY run_id)"""


@query(S.with_(*S.FULL) + _REGIMES + "--result SELECT * FROM regimes", "regime_stability")
def q_regime_stability(spark, d):
    return B.regime_stability(daily(spark, d))


_BLOCKS = """, sized AS (SELECT *, ceil(n::DOUBLE / b)::BIGINT AS size FROM (SELECT run_id, count(*) AS n, greatest(2, least(8, count(*))) AS b, arg_max(strategy_return, date) AS last FROM daily GROUP BY run_id)),
  numbered AS (SELECT run_id, strategy_return AS r, row_number() OVER (PARTITION BY run_id ORDER BY date) - 1 AS i FROM daily), grid AS (SELECT run_id, n, b, size, last, unnest(range(b)) AS block FROM sized),
  block_sums AS (SELECT run_id, i // size AS block, sum(r) AS s, count(*) AS c FROM numbered JOIN sized USING (run_id) GROUP BY ALL),
  block_means AS (SELECT g.run_id, g.block, g.n, g.b, (coalesce(s.s, 0) + (g.size - coalesce(s.c, 0)) * g.last) / g.size AS m FROM grid g LEFT JOIN block_sums s USING (run_id, block)),
  block_order AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY m, block) AS r FROM block_means),
  blocks AS (SELECT run_id, CASE WHEN any_value(n) >= 2 THEN -avg(m) + sqrt(var_pop(m) + 1e-8) - avg(m) FILTER (r <= greatest(1, round_even(b * 0.25, 0))) ELSE 0 END AS block_stability FROM block_order GROUP BY run_id)"""


@query(S.with_(*S.FULL) + _BLOCKS + "--result SELECT * FROM blocks", "block_stability")
def q_block_stability(spark, d):
    return B.block_stability(daily(spark, d), "strategy_return")


_EXCESS = f""", x AS (SELECT *, strategy_return - benchmark_return AS excess, exp(greatest(least(sum(strategy_return - benchmark_return) OVER (PARTITION BY run_id ORDER BY date), 60), -60)) AS equity FROM daily),
  q AS (SELECT run_id, quantile_cont(-excess, 0.95) AS v FROM x GROUP BY run_id), y AS (SELECT *, equity / greatest(max(equity) OVER (PARTITION BY run_id ORDER BY date), 1e-12) - 1 AS dd FROM x),
  risk AS (SELECT *, {_SOFT("((-relative_drawdown - 0.2) * 20)")} / 20 AS penalty FROM (SELECT run_id, avg(excess) AS mean_excess, any_value(v) AS value_at_risk, min(dd) AS relative_drawdown, any_value(v) + avg(greatest(-excess - v, 0)) / (1 - 0.95) AS cvar FROM y JOIN q USING (run_id) GROUP BY run_id))"""


@query(S.with_(*S.FULL) + _EXCESS + "--result SELECT run_id, mean_excess, value_at_risk, relative_drawdown, cvar, penalty FROM risk", "mean_excess value_at_risk relative_drawdown cvar penalty")
def q_excess_risk(spark, d):
    return B.excess_risk(daily(spark, d))


@query(
    S.with_(*S.FULL) + _REGIMES + _BLOCKS + _EXCESS + """, runs_ AS (SELECT run_id, avg(strategy_return) / sqrt(var_pop(strategy_return) + 1e-8) * sqrt(252) AS sharpe, avg(turnover) AS t, avg(greatest(benchmark_return - strategy_return, 0)) AS under FROM daily GROUP BY run_id)
    --result SELECT run_id, -sharpe + 0.1 * t AS sharpe_turnover, -mean_excess + cvar AS excess_cvar_drawdown, -mean_excess + cvar + under + greatest(cvar - 0.03, 0) + greatest(-relative_drawdown - 0.2, 0) AS outperformance, regime_stability + block_stability AS generalization
    FROM runs_ JOIN risk USING (run_id) JOIN regimes USING (run_id) JOIN blocks USING (run_id)""",
    "sharpe_turnover excess_cvar_drawdown outperformance generalization",
)
def q_objective_scorecard(spark, d):
    return B.objective_scorecard(daily(spark, d))


@query(
    S.with_(*S.PANEL, S.BOOK) + """, w AS (SELECT *, CASE WHEN tradable THEN weight ELSE 0 END AS w FROM book), p AS (SELECT *, CASE WHEN tradable THEN lag(w, 1, 0.0) OVER (PARTITION BY run_id, symbol ORDER BY date) ELSE 0 END AS p FROM w),
    n AS (SELECT run_id, sum(w * coalesce(return_1d, 0)) AS r, sum(abs(w - p)) AS t, sum(w * w) AS c FROM p GROUP BY run_id, date)
    --result SELECT run_id, -avg(r - 0.001425 * t) / sqrt(var_pop(r - 0.001425 * t) + 1e-8) * sqrt(252) + 0.1 * avg(t) + 0.01 * avg(c) AS objective FROM n GROUP BY run_id""",
    "objective",
)
def q_autoencoder_objective(spark, d):
    return B.portfolio_autoencoder_objective(book(spark, d))


@query(S.with_(*S.PANEL) + "--result SELECT date, symbol, CASE WHEN tradable THEN row_number() OVER (PARTITION BY date, tradable ORDER BY shadow_imbalance DESC NULLS LAST, symbol) - 1 ELSE count(*) OVER (PARTITION BY date) END AS position FROM feats")
def q_rank_position(spark, d):
    return B.rank_position(panel(spark, d), "shadow_imbalance", "position", F.col("tradable")).select("date", "symbol", "position")


@query(S.with_(*S.PANEL) + "--result SELECT sum(pow(close_logret_1d - return_1d, 2)) FILTER (tradable) / greatest(count(pow(close_logret_1d - return_1d, 2)) FILTER (tradable), 1) AS mse FROM feats", "mse")
def q_masked_mse(spark, d):
    return B.masked_mse(panel(spark, d), "close_logret_1d", F.col("tradable"))


@query(
    S.with_(*S.FULL) + "--result SELECT run_id, sum(strategy_return) AS total_return, sum(turnover) AS total_turnover, count(*) AS valid_days, -252 * sum(strategy_return) / count(*) + 0.1 * sum(turnover) / count(*) AS loss FROM daily WHERE benchmark_return != 0 GROUP BY run_id",
    "total_return total_turnover loss",
)
def q_masked_totals(spark, d):
    return B.masked_totals(daily(spark, d), F.col("benchmark_return") != 0)


_CARRY = """, carried AS (SELECT *, coalesce(last_value(CASE WHEN tradable THEN weight END IGNORE NULLS) OVER (PARTITION BY run_id, symbol ORDER BY date ROWS UNBOUNDED PRECEDING), 0.0) AS w FROM book)"""


@query(S.with_(*S.PANEL, S.BOOK) + _CARRY + "--result SELECT run_id, date, symbol, w AS weight FROM carried", "weight")
def q_carry_backtest(spark, d):
    return B.carry(book(spark, d)).select("run_id", "date", "symbol", "weight")


def masked_book(spark: SparkSession, d: str) -> DataFrame:
    masks = P.limit_masks(panel(spark, d)).select("date", "symbol", "can_buy", "can_sell")
    out = book(spark, d).join(masks, ["date", "symbol"], "left")
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("can_buy", "can_sell")})


@query(
    S.with_(*S.PANEL, S.MASKS, S.BOOK).replace("WITH", "WITH RECURSIVE", 1) + """, sided AS (
      SELECT b.run_id, b.date, b.symbol, b.weight, coalesce(m.can_buy, false) AS up, coalesce(m.can_sell, false) AS down FROM book b LEFT JOIN masks m USING (date, symbol)
    ), days AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY date) AS i, date, list(weight ORDER BY run_id, symbol) AS target, list(up ORDER BY run_id, symbol) AS up, list(down ORDER BY run_id, symbol) AS down FROM sided GROUP BY date
    ), walk(i, held) AS (
      SELECT 0::BIGINT, list_transform(target, lambda x: 0.0::DOUBLE) FROM days WHERE i = 1
      UNION ALL
      SELECT d.i, list_transform(list_zip(held, target, up, down), lambda z: CASE WHEN z[2] > z[1] AND z[3] OR z[2] < z[1] AND z[4] THEN z[2] ELSE z[1] END) FROM walk w JOIN days d ON d.i = w.i + 1
    ), names AS (SELECT run_id, symbol, row_number() OVER (ORDER BY run_id, symbol) AS k FROM (SELECT DISTINCT run_id, symbol FROM sided))
    --result SELECT run_id, date, symbol, held[k] AS weight FROM walk JOIN days USING (i), names""",
    "weight",
)
def q_side_mask_backtest(spark, d):
    return B.side_masks(masked_book(spark, d)).select("run_id", "date", "symbol", "weight")


@query(
    S.with_(*S.PANEL, S.BOOK) + _CARRY + """, t AS (SELECT run_id, date, sum(abs(w - p)) AS t, sum(abs(w)) AS g FROM (SELECT *, lag(w, 1, 0.0) OVER (PARTITION BY run_id, symbol ORDER BY date) AS p FROM carried) GROUP BY ALL)
    --result SELECT run_id, min(CASE WHEN g > 1 + 1e-9 OR t > 0.65 + 1e-9 THEN date END) AS first_violation FROM t GROUP BY run_id"""
)
def q_constraint_check(spark, d):
    return B.constraint_check(B.carry(book(spark, d)), 0.65)


@query()
def q_constrained_replay(spark, d):
    return B.constrained_replay(masked_book(spark, d), 0.65, long_only=True)


@query(
    S.with_(*S.PANEL, S.BOOK) + """, s AS (SELECT *, greatest(weight, 0) / greatest(sum(greatest(weight, 0)) OVER (PARTITION BY run_id, date), 1e-12) AS s FROM book),
    l AS (SELECT *, lag(s, 1, 0.0) OVER o AS w, lag(s, 2, 0.0) OVER o AS p FROM s WINDOW o AS (PARTITION BY run_id, symbol ORDER BY date))
    --result SELECT run_id, date, sum(w * coalesce(return_1d, 0)) AS gross_return, sum(abs(w - p)) AS turnover, sum(w * coalesce(return_1d, 0)) - 0.001 * sum(abs(w - p)) AS strategy_return FROM l GROUP BY run_id, date""",
    "gross_return turnover strategy_return",
)
def q_lagged_backtest(spark, d):
    return B.lagged_daily(book(spark, d), 0.001)


@query(
    S.with_(*S.PANEL, S.BOOK) + """, g AS (SELECT *, CASE WHEN tradable THEN greatest(weight, 0) ELSE 0 END AS x, count(*) FILTER (tradable) OVER (PARTITION BY run_id, date) AS n FROM book), s AS (SELECT *, sum(x) OVER (PARTITION BY run_id, date) AS g FROM g),
    e AS (SELECT *, CASE WHEN g > 1e-8 THEN x / g WHEN tradable THEN 1.0::DOUBLE / n ELSE 0 END AS e FROM s), m AS (SELECT *, abs(e - lag(e, 1, 0.0) OVER (PARTITION BY run_id, symbol ORDER BY date)) AS d FROM e)
    --result SELECT run_id, date, sum(e * coalesce(return_1d, 0)) AS gross_return, sum(d) AS turnover, sum(e * coalesce(return_1d, 0)) - 0.001 * sum(d) AS reward FROM m GROUP BY run_id, date""",
    "gross_return turnover reward",
)
def q_policy_reward(spark, d):
    return B.policy_reward(book(spark, d), 0.001)


_EXPOSURE = """, masked_ AS (SELECT *, CASE WHEN tradable THEN weight ELSE 0 END AS w, CASE WHEN tradable THEN coalesce(return_1d, 0) ELSE 0 END AS r FROM book),
  mv AS (SELECT *, abs(w - lag(w) OVER (PARTITION BY run_id, symbol ORDER BY date)) AS d FROM masked_), expo AS (
  SELECT run_id, date, sum(abs(w)) AS gross, sum(w) AS net, sum(greatest(w, 0)) AS long, sum(greatest(-w, 0)) AS short, max(abs(w)) AS max_abs_weight, sum(w * w) / pow(greatest(sum(abs(w)), 1e-12), 2) AS hhi, coalesce(sum(d), 0.0) AS turnover,
    sum(w * r) AS strategy_return, sum(r) / greatest(count(*) FILTER (tradable), 1) AS market_return, count(*) FILTER (tradable) AS active, coalesce(sum(abs(weight)) FILTER (NOT tradable), 0.0) AS untradable_abs_weight FROM mv GROUP BY run_id, date)"""
_EXPO = "gross net long short max_abs_weight hhi turnover strategy_return market_return untradable_abs_weight"


@query(S.with_(*S.PANEL, S.BOOK) + _EXPOSURE + "--result SELECT * FROM expo", _EXPO)
def q_portfolio_exposure(spark, d):
    return B.portfolio_exposure(book(spark, d))


_SUMMARY = "mean_gross mean_abs_net mean_long_gross mean_short_gross mean_scaled_hhi max_abs_weight_mean max_abs_weight_max mean_daily_log_return mean_turnover_proxy untradable_abs_weight_sum"


@query(
    S.with_(*S.PANEL, S.BOOK) + """, mv AS (SELECT *, abs(weight - lag(weight) OVER (PARTITION BY run_id, symbol ORDER BY date)) AS d FROM book),
    day AS (SELECT run_id, count(*) AS n, sum(abs(weight)) AS gross, sum(weight) AS net, sum(greatest(weight, 0)) AS long, sum(greatest(-weight, 0)) AS short, sum(weight * weight) * greatest(count(*) FILTER (tradable), 1) AS hhi, max(abs(weight)) AS top,
      sum(weight * coalesce(return_1d, 0)) AS r, sum(d) AS t, coalesce(sum(abs(weight)) FILTER (NOT tradable), 0.0) AS u FROM mv GROUP BY run_id, date)
    --result SELECT run_id, count(*) AS rows, max(n) AS symbols, avg(gross) AS mean_gross, avg(abs(net)) AS mean_abs_net, avg(long) AS mean_long_gross, avg(short) AS mean_short_gross, avg(hhi) AS mean_scaled_hhi, avg(top) AS max_abs_weight_mean, max(top) AS max_abs_weight_max,
      avg(r) AS mean_daily_log_return, coalesce(avg(t), 0.0) AS mean_turnover_proxy, sum(u) AS untradable_abs_weight_sum FROM day GROUP BY run_id""",
    _SUMMARY,
)
def q_portfolio_summary(spark, d):
    return B.portfolio_summary(book(spark, d))


@query(S.with_(*S.PANEL, S.BOOK) + "--result SELECT run_id, date, coalesce(sum(weight * weight) / nullif(pow(sum(abs(weight)), 2), 0), 0.0) AS hhi, max(abs(weight)) AS max_abs_weight FROM book GROUP BY ALL", "hhi max_abs_weight")
def q_concentration(spark, d):
    return B.concentration(book(spark, d))


@query(
    S.with_(*S.PANEL, S.BOOK) + """--result SELECT *, total_contribution / greatest(active_days, 1) AS contribution_per_active_day FROM (
    SELECT run_id, symbol, avg(weight) AS mean_weight, avg(abs(weight)) AS mean_abs_weight, sum(CASE WHEN tradable THEN weight * coalesce(return_1d, 0) ELSE 0 END) AS total_contribution, count(*) FILTER (tradable) AS active_days FROM book GROUP BY ALL)""",
    "mean_weight mean_abs_weight total_contribution contribution_per_active_day",
)
def q_symbol_contribution(spark, d):
    return B.symbol_contribution(book(spark, d))


_REGIME = "count(*) AS rows, avg(strategy_return) AS mean_strategy_return, avg(market_return) AS mean_market_return, avg(turnover) AS mean_turnover, avg(gross) AS mean_gross, avg(net) AS mean_net, avg((strategy_return > 0)::INT) AS hit_rate"


@query(
    S.with_(*S.PANEL, S.BOOK) + _EXPOSURE + f""", e AS (SELECT run_id, quantile_cont(abs(market_return), 1.0/3) AS a, quantile_cont(abs(market_return), 2.0/3) AS b, count(*) AS c, min(abs(market_return)) AS lo, max(abs(market_return)) AS hi FROM expo GROUP BY run_id)
    --result SELECT run_id, 'market_direction' AS dimension, CASE WHEN market_return > 0.001 THEN 'market_up' WHEN market_return < -0.001 THEN 'market_down' ELSE 'market_flat' END AS regime, {_REGIME} FROM expo GROUP BY ALL
    UNION ALL SELECT run_id, 'volatility_bucket', CASE WHEN c < 3 OR hi <= lo THEN 'single_vol_bucket' WHEN abs(market_return) < a THEN 'low_abs_market_move' WHEN abs(market_return) < b THEN 'mid_abs_market_move' ELSE 'high_abs_market_move' END, {_REGIME} FROM expo JOIN e USING (run_id) GROUP BY ALL""",
    "mean_strategy_return mean_market_return mean_turnover mean_gross mean_net hit_rate",
)
def q_regime_analysis(spark, d):
    return B.regime_analysis(B.portfolio_exposure(book(spark, d)))


@query(
    S.with_(*S.PANEL, S.BOOK) + """--result SELECT run_id, date, symbol, weight, r AS rank, CASE WHEN weight > 0 THEN 'long' WHEN weight < 0 THEN 'short' ELSE 'flat' END AS side FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id, date ORDER BY abs(weight) DESC, symbol) AS r FROM book) WHERE r <= 3""",
    "weight",
)
def q_daily_decisions(spark, d):
    return B.daily_decisions(book(spark, d), 3).select("run_id", "date", "symbol", "weight", "rank", "side")


_CASE = "strategy_return market_return turnover gross net".split()


@query(
    S.with_(*S.PANEL, S.BOOK) + _EXPOSURE + f""", best AS (
      SELECT run_id, unnest([{{'case_type': 'best_strategy_day', 'date': arg_min(date, (-round(strategy_return, 9), date))}}, {{'case_type': 'worst_strategy_day', 'date': arg_min(date, (round(strategy_return, 9), date))}},
        {{'case_type': 'highest_turnover_day', 'date': arg_min(date, (-round(turnover, 9), date))}}, {{'case_type': 'highest_gross_exposure_day', 'date': arg_min(date, (-round(gross, 9), date))}}], recursive := true) FROM expo GROUP BY run_id),
    ranked_ AS (SELECT *, row_number() OVER (PARTITION BY run_id, date ORDER BY abs(weight) DESC, symbol) AS rank FROM book)
    --result SELECT run_id, case_type, date, symbol, weight, rank, CASE WHEN weight > 0 THEN 'long' WHEN weight < 0 THEN 'short' ELSE 'flat' END AS side, {', '.join(f'e.{c} AS case_{c}' for c in _CASE)}
    FROM ranked_ JOIN best USING (run_id, date) JOIN expo e USING (run_id, date) WHERE rank <= 5""",
    "weight " + " ".join(f"case_{c}" for c in _CASE),
)
def q_case_studies(spark, d):
    x = book(spark, d)
    return B.case_studies(x, cut(B.portfolio_exposure(x))).select("run_id", "case_type", "date", "symbol", "weight", "rank", "side", *(f"case_{c}" for c in _CASE))


@query(S.with_(*S.FULL) + f", y AS ({S.metrics('run_id, year', '1e-8')}), t AS ({S.metrics('run_id')}), r AS (SELECT run_id, year::VARCHAR AS label, cumulative_return, sharpe, max_drawdown, mean_turnover FROM y UNION ALL SELECT run_id, 'total', cumulative_return, sharpe, max_drawdown, mean_turnover FROM t)--result SELECT run_id, label, printf('%-6s %10.4f %10.4f %10.4f %10.4f', label, cumulative_return, sharpe, max_drawdown, mean_turnover) AS line FROM r")
def q_annual_report_lines(spark, d):
    x = daily(spark, d)
    return B.annual_report_lines(B.metrics_by_year(x), B.performance_metrics(x))


# ---- folds -------------------------------------------------------------------

_FOLDS = ", years AS (SELECT DISTINCT year(date)::INT AS y FROM bars), o AS (SELECT y, row_number() OVER (ORDER BY y) AS i, count(*) OVER () AS n, min(y) OVER () AS a, max(y) OVER () AS b FROM years), folds AS (SELECT (i - 2)::INT AS fold_id, y AS val_year, a AS first_year, b AS last_year FROM o WHERE i > 1 AND i < n)"


@query(S.with_(S.BARS_SQL) + _FOLDS + "--result SELECT * FROM folds")
def q_expanding_folds(spark, d):
    return B.expanding_year_folds(bars(spark, d))


@query(
    S.with_(*S.FULL) + _FOLDS + """, a AS (SELECT d.*, f.fold_id, CASE WHEN year(date) < val_year THEN 'train' WHEN year(date) = val_year THEN 'val' ELSE 'test' END AS split FROM daily d, folds f)
    --result SELECT run_id, fold_id, split, count(*) AS days, sum(strategy_return) AS log_return, avg(turnover) AS mean_turnover FROM a GROUP BY ALL""",
    "log_return mean_turnover",
)
def q_assign_folds(spark, d):
    a = B.assign_folds(daily(spark, d), B.expanding_year_folds(bars(spark, d)))
    return a.groupBy("run_id", "fold_id", "split").agg(F.count("*").alias("days"), F.sum("strategy_return").alias("log_return"), F.avg("turnover").alias("mean_turnover"))


@query(
    S.with_(*S.FULL) + _FOLDS + f""", a AS (SELECT d.*, f.fold_id, min(year(date)) FILTER (year(date) > val_year) OVER (PARTITION BY f.fold_id) AS y1 FROM daily d, folds f), firsts AS (SELECT * FROM a WHERE year(date) = y1),
    conc AS (SELECT run_id, date, coalesce(sum(weight * weight) / nullif(pow(sum(abs(weight)), 2), 0), 0.0) AS hhi, max(abs(weight)) AS top FROM book GROUP BY ALL), m AS ({S.metrics("run_id, fold_id, year", "1e-8", "firsts")}),
    l AS (SELECT run_id, fold_id, year(date)::INT AS year, sum(strategy_return) AS log_return, sum(benchmark_return) AS log_baseline, avg(hhi) AS mean_hhi, avg(top) AS mean_max_weight FROM firsts JOIN conc USING (run_id, date) GROUP BY ALL)
    --result SELECT * FROM m JOIN l USING (run_id, fold_id, year)""",
    FIGURES + " log_return log_baseline mean_hhi mean_max_weight",
)
def q_fold_first_year(spark, d):
    x = momentum(spark, d)
    b = book_of(x)
    days = B.portfolio_daily(b, 0.001, 0.003).join(B.universe_average(x), "date")
    return W.first_year_report(B.assign_folds(days, B.expanding_year_folds(x)), B.concentration(b))


_SPLITS = _FOLDS + """, split_rows AS (SELECT f.fold_id, CASE WHEN year(date) < val_year THEN 'train' WHEN year(date) = val_year THEN 'val' ELSE 'test' END AS split, date, symbol, tradable, return_1d, close_logret_1d FROM feats, folds f)"""


@query(S.with_(*S.PANEL) + _SPLITS + ", w AS (SELECT *, row_number() OVER (PARTITION BY fold_id, split ORDER BY date) AS i FROM (SELECT fold_id, split, date, bool_or(tradable AND return_1d IS NOT NULL) AS ok FROM split_rows GROUP BY ALL))--result SELECT fold_id, split, date FROM w WHERE i >= 20 AND ok")
def q_window_dates(spark, d):
    x = panel(spark, d)
    return W.window_dates(B.assign_folds(x, B.expanding_year_folds(x)), 20)


@query(
    S.with_(*S.PANEL) + _SPLITS + """, t AS (SELECT fold_id, date, symbol, close_logret_1d * (fold_id + 1) AS score, min(date) OVER (PARTITION BY fold_id) AS first_date, dense_rank() OVER (PARTITION BY fold_id ORDER BY date) AS i FROM split_rows WHERE split = 'test'),
    own AS (SELECT * FROM t WHERE i >= 20), lim AS (SELECT fold_id, min(date) AS lo, any_value(first_date) AS split FROM own GROUP BY fold_id)
    --result SELECT fold_id, date, symbol, score, false AS warmup FROM own UNION ALL SELECT (o.fold_id + 1)::INT, date, symbol, score, true FROM own o JOIN lim ON lim.fold_id = o.fold_id + 1 WHERE date < lo AND date >= split""",
    "score",
)
def q_warmup_union(spark, d):
    x = panel(spark, d)
    a = B.assign_folds(x, B.expanding_year_folds(x)).where("split = 'test'")
    first = a.groupBy("fold_id").agg(F.min("date").alias("first_date"))
    place = F.dense_rank().over(Window.partitionBy("fold_id").orderBy("date"))
    own = a.withColumn("_i", place).where("_i >= 20").join(first, "fold_id").select("fold_id", "date", "first_date", "symbol", (F.col("close_logret_1d") * (F.col("fold_id") + 1)).alias("score"))
    return W.warmup_union(own).select("fold_id", "date", "symbol", "score", "warmup")


@query(
    S.with_(S.BARS_SQL) + """, days AS (SELECT DISTINCT date, quarter(date)::INT AS fold_id FROM bars), n AS (SELECT *, sum(new) OVER (ORDER BY date) AS segment FROM (SELECT *, coalesce((fold_id != lag(fold_id) OVER (ORDER BY date))::BIGINT, 0) AS new FROM days))
    --result SELECT segment::BIGINT AS segment, fold_id, min(date) AS "first", max(date) AS "last", count(*) AS rows FROM n GROUP BY ALL"""
)
def q_segments(spark, d):
    return W.segments(bars(spark, d).select("date").distinct().withColumn("fold_id", F.quarter("date")), "fold_id")


@query(
    S.with_(*S.PANEL, S.BOOK) + """, m AS (SELECT *, year(date)::BIGINT AS segment, abs(weight - lag(weight, 1, 0.0) OVER (PARTITION BY run_id, year(date), symbol ORDER BY date)) AS d FROM book)
    --result SELECT run_id, segment, date, sum(weight * coalesce(return_1d, 0)) AS gross_return, sum(d) AS turnover FROM m GROUP BY ALL""",
    "gross_return turnover",
)
def q_segment_turnover(spark, d):
    return W.segment_turnover(book(spark, d).withColumn("segment", F.year("date").cast("long")))


@query()
def q_fold_report(spark, d):
    x = panel(spark, d)
    return W.fold_report(W.fold_scores(x, B.expanding_year_folds(x), MODEL), 5, 0.001, 0.003)


@query(S.with_(*S.FULL) + _FOLDS + """, a AS (SELECT d.*, f.fold_id, min(year(date)) FILTER (year(date) > val_year) OVER (PARTITION BY f.fold_id) AS y1 FROM daily d, folds f)
    --result SELECT run_id, date, fold_id, exp(greatest(least(sum(strategy_return) OVER (PARTITION BY run_id ORDER BY date), 60), -60)) AS equity FROM a WHERE year(date) = y1""", 'equity')
def q_stitched_equity(spark, d):
    x = B.stitch_first_years(B.assign_folds(daily(spark, d), B.expanding_year_folds(bars(spark, d))))
    return B.equity_curve(x, "strategy_return").select("run_id", "date", "fold_id", "equity")


# ---- cleaning, audit, repair ------------------------------------------------


def order_bars(spark: SparkSession, d: str) -> DataFrame:
    """Irregular series with repeated days: a customer's orders."""
    o = table(spark, d, "orders")
    p = F.col("o_totalprice").cast("double")
    return o.select(F.concat(F.lit("C"), F.col("o_custkey") % 50).alias("symbol"), F.to_date("o_orderdate").alias("date"), p.alias("open"), (p * 1.01).alias("max"), F.when(F.col("o_orderkey") % 97 == 0, p * 1.5).otherwise(p * 0.99).alias("min"), F.when(F.col("o_orderkey") % 89 != 0, p).alias("close"), p.alias("adjclose"), F.when(F.col("o_orderkey") % 83 == 0, -1.0).otherwise(1.0).alias("Trading_Volume"), F.col("o_orderkey").alias("ingest_seq"))


_ORDERS = """WITH ob AS (SELECT 'C' || (o_custkey % 50) AS symbol, CAST(o_orderdate AS DATE) AS date, p AS open, p * 1.01::DOUBLE AS "max", CASE WHEN o_orderkey % 97 = 0 THEN p * 1.5::DOUBLE ELSE p * 0.99::DOUBLE END AS "min",
  CASE WHEN o_orderkey % 89 != 0 THEN p END AS close, p AS adjclose, CASE WHEN o_orderkey % 83 = 0 THEN -1.0 ELSE 1.0 END::DOUBLE AS "Trading_Volume", o_orderkey AS ingest_seq FROM (SELECT *, o_totalprice::DOUBLE AS p FROM orders))"""


_GAPS = """, dup AS (SELECT symbol, coalesce(sum(c) FILTER (c > 1), 0)::BIGINT AS duplicate_dates FROM (SELECT symbol, date, count(*) AS c FROM ob GROUP BY ALL) GROUP BY symbol),
    p AS (SELECT * FROM (SELECT symbol, date_diff('second', lag(date) OVER (PARTITION BY symbol ORDER BY date), date)::DOUBLE AS delta, count(*) OVER (PARTITION BY symbol) AS n FROM ob) WHERE delta > 0 AND n >= 3),
    f AS (SELECT symbol, max(delta) AS max_gap_seconds, median(delta) AS m FROM p GROUP BY symbol), gc AS (SELECT symbol, any_value(max_gap_seconds) AS max_gap_seconds, count(*) FILTER (delta > CASE WHEN m < 43200 THEN greatest(m, 1) * 4 ELSE 864000 END) AS gap_count FROM f JOIN p USING (symbol) GROUP BY symbol)"""


@query(
    _ORDERS + _GAPS + """, a AS (SELECT symbol, count(*) AS rows, min(date) AS first_date, max(date) AS last_date, 0::BIGINT AS invalid_dates, count(*) FILTER (open IS NULL OR "max" IS NULL OR "min" IS NULL OR close IS NULL) AS nan_ohlc_rows,
      count(*) FILTER ("max" < "min" OR "max" < open OR "max" < close OR "min" > open OR "min" > close) AS bad_ohlc_rows, count(*) FILTER (open <= 0 OR "max" <= 0 OR "min" <= 0 OR close <= 0) AS nonpositive_price_rows,
      count(*) FILTER ("Trading_Volume" < 0) AS negative_volume_rows FROM ob GROUP BY symbol),
    s AS (SELECT a.*, duplicate_dates, max_gap_seconds, coalesce(gap_count, 0) AS gap_count, datediff('day', last_date, max(last_date) OVER ())::INT AS stale_days, NULL::VARCHAR AS missing_columns FROM a JOIN dup USING (symbol) LEFT JOIN gc USING (symbol)),
    t AS (SELECT *, array_to_string(list_sort(list_filter([CASE WHEN duplicate_dates > 0 THEN 'duplicate_dates' END, CASE WHEN nan_ohlc_rows > 0 THEN 'nan_ohlc' END, CASE WHEN bad_ohlc_rows > 0 THEN 'bad_ohlc' END, CASE WHEN gap_count > 0 THEN 'large_gaps' END,
      CASE WHEN nonpositive_price_rows > 0 THEN 'nonpositive_price' END, CASE WHEN negative_volume_rows > 0 THEN 'negative_volume' END, CASE WHEN stale_days > 5 THEN 'stale' END], lambda x: x IS NOT NULL)), '|') AS issues FROM s)
    --result SELECT *, CASE WHEN issues != '' THEN 'warn' ELSE 'ok' END AS status FROM t""",
    "max_gap_seconds",
)
def q_audit_bars(spark, d):
    return C.audit(order_bars(spark, d))


@query(f"WITH a AS ({ORACLES['q_audit_bars']})--result SELECT 'status' AS kind, status AS value, count(*) AS count FROM a GROUP BY status UNION ALL SELECT 'issue', i, count(*) FROM (SELECT unnest(string_split(issues, '|')) AS i FROM a WHERE issues != '') GROUP BY i")
def q_audit_counts(spark, d):
    a = C.audit(order_bars(spark, d))
    return C.status_counts(a).select(F.lit("status").alias("kind"), F.col("status").alias("value"), "count").unionAll(C.issue_counts(a).select(F.lit("issue"), "issue", "count"))


@query(_ORDERS + "--result SELECT symbol, coalesce(sum(c) FILTER (c > 1), 0)::BIGINT AS duplicate_rows FROM (SELECT symbol, date, count(*) AS c FROM ob GROUP BY ALL) GROUP BY symbol")
def q_duplicate_dates(spark, d):
    return C.duplicate_dates(order_bars(spark, d))


@query(
    _ORDERS + """, g AS (SELECT symbol, date_diff('second', lag(date) OVER (PARTITION BY symbol ORDER BY date), date) AS delta FROM ob), p AS (SELECT * FROM g WHERE delta > 0),
    f AS (SELECT symbol, median(delta) AS median_gap, max(delta) AS max_gap FROM p GROUP BY symbol HAVING count(*) >= 2), t AS (SELECT *, CASE WHEN median_gap < 43200 THEN 4 * median_gap ELSE 864000.0 END AS threshold FROM f)
    --result SELECT t.symbol, median_gap, max_gap, threshold, count(*) FILTER (delta > threshold) AS large_gaps FROM t JOIN p USING (symbol) GROUP BY ALL""",
    "median_gap threshold",
)
def q_gap_summary(spark, d):
    return C.gap_summary(order_bars(spark, d))


@query(
    _ORDERS + """, g AS (SELECT symbol, date_diff('second', lag(date) OVER (PARTITION BY symbol ORDER BY date), date) AS delta FROM ob)
    --result SELECT *, bars < 3 OR coalesce(long_share <= 0.05 AND NOT (midnight_share > 0.95 AND median_delta >= 43200) AND median_delta <= 4 * 900, true) AS passes
    FROM (SELECT symbol, count(*) AS bars, median(delta) FILTER (delta > 0) AS median_delta, avg((delta >= 43200)::INT) FILTER (delta > 0) AS long_share, 1.0::DOUBLE AS midnight_share FROM g GROUP BY symbol)""",
    "median_delta long_share midnight_share",
)
def q_interval_check(spark, d):
    return C.interval_check(order_bars(spark, d), 900)


_KEPT = ', kept AS (SELECT * FROM ob WHERE close IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ingest_seq DESC) = 1)'


@query(_ORDERS + _KEPT + '--result SELECT symbol, date, open, "max", "min", close, adjclose, "Trading_Volume", ingest_seq FROM kept', RAW)
def q_canonical_bars(spark, d):
    x = order_bars(spark, d).withColumn("empty", F.lit(None).cast("double")).withColumn("date", F.col("date").cast("string"))
    return C.canonical(x)


@query(
    _ORDERS + _KEPT + """, cal AS (SELECT DISTINCT date FROM kept), sp AS (SELECT symbol, min(date) AS lo, max(date) AS hi FROM kept GROUP BY symbol), g AS (SELECT symbol, cal.date FROM sp JOIN cal ON cal.date BETWEEN lo AND hi),
    j AS (SELECT g.symbol, g.date, open, close, "Trading_Volume" FROM g LEFT JOIN kept USING (symbol, date)), f AS (SELECT symbol, date, open, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS close, coalesce("Trading_Volume", 0.0) AS "Trading_Volume" FROM j)
    --result SELECT symbol, date, coalesce(open, close) AS open, close, "Trading_Volume" FROM f""",
    'open close "Trading_Volume"',
)
def q_calendar_fill(spark, d):
    x = C.keep_last(order_bars(spark, d).where("close is not null"), ["symbol", "date"])
    return C.forward_fill(C.reindex_to_calendar(x, C.market_calendar(x))).select("symbol", "date", "open", "close", "Trading_Volume")


@query(_ORDERS + "--result SELECT symbol, max(date) AS last_date, greatest(DATE '1996-01-01', max(date) + 1)::DATE AS next_start FROM ob GROUP BY symbol")
def q_high_water_mark(spark, d):
    return C.high_water_mark(order_bars(spark, d), "1996-01-01")


@query(
    _ORDERS + """, o AS (SELECT * FROM ob WHERE date < DATE '1998-01-01'), n AS (SELECT * FROM ob WHERE date >= DATE '1997-06-01')
    --result SELECT a.symbol, a.c - coalesce(b.c, 0) AS added, CASE WHEN a.c - coalesce(b.c, 0) > 0 THEN 'updated' ELSE 'up_to_date' END AS status FROM (SELECT symbol, count(DISTINCT date) AS c FROM (SELECT * FROM o UNION ALL SELECT * FROM n) GROUP BY symbol) a LEFT JOIN (SELECT symbol, count(DISTINCT date) AS c FROM o GROUP BY symbol) b USING (symbol)"""
)
def q_incremental_merge(spark, d):
    x = order_bars(spark, d)
    return C.incremental_merge(x.where("date < '1998-01-01'"), x.where("date >= '1997-06-01'"))[1]


@query(_ORDERS + "--result SELECT symbol, count(DISTINCT CASE WHEN month(date) = 1 THEN year(date) END) AS january_years, CASE WHEN count(DISTINCT CASE WHEN month(date) = 1 THEN year(date) END) > 0 THEN 'historical_found' ELSE 'no_history' END AS status FROM ob GROUP BY symbol")
def q_january_years(spark, d):
    return C.january_years(order_bars(spark, d))


@query(S.with_(*S.PANEL) + "--result SELECT symbol, count(*) AS tradable_days FROM feats WHERE tradable AND date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY symbol ORDER BY 2 DESC, 1 LIMIT 8")
def q_tradable_counts(spark, d):
    return C.tradable_counts(panel(spark, d), "1996-01-01", "1998-12-31", 8)


def repair_rules(spark: SparkSession, d: str) -> DataFrame:
    """One rule per nation: scale a month, or mend single days by their neighbours."""
    n = table(spark, d, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("symbol"), F.col("n_nationkey").alias("k"))
    odd = F.col("k") % 2 == 1
    return n.select(
        "symbol", F.when(odd, "scale").otherwise("neighbour").alias("method"), F.lit(0.01).alias("factor"), F.when(~odd, F.array(F.to_date(F.lit("1997-03-03")), F.to_date(F.lit("1997-03-10")))).alias("dates"),
        F.when(odd, F.to_date(F.lit("1998-02-01"))).alias("first"), F.when(odd, F.to_date(F.lit("1998-02-28"))).alias("last"),
    )


@query(
    S.with_(S.BARS_SQL) + """, w AS (SELECT symbol, date, close, lag(close) OVER s AS p, lead(close) OVER s AS n, CAST(substr(symbol, 2) AS INT) % 2 = 1 AS odd FROM bars WINDOW s AS (PARTITION BY symbol ORDER BY date)),
    r AS (SELECT *, CASE WHEN odd AND date BETWEEN DATE '1998-02-01' AND DATE '1998-02-28' THEN 'scale' WHEN NOT odd AND date IN (DATE '1997-03-03', DATE '1997-03-10') THEN 'neighbour' END AS repair FROM w)
    --result SELECT symbol, date, CASE repair WHEN 'scale' THEN close * 0.01::DOUBLE WHEN 'neighbour' THEN coalesce((p + n) / 2, p, n, close) ELSE close END AS close, repair FROM r""",
    "close",
)
def q_apply_repair_rules(spark, d):
    return C.apply_repair_rules(bars(spark, d), repair_rules(spark, d)).select("symbol", "date", "close", "repair")


def better_source(spark: SparkSession, d: str) -> DataFrame:
    x = bars(spark, d)
    day = F.dayofmonth("date")
    price = lambda c: F.when(day == 1, F.lit(0.0)).when(day == 2, F.col(c) * 1.5).otherwise(F.col(c))
    return x.where("dayofmonth(date) < 20").select("symbol", "date", *(price(c).alias(c) for c in ("open", "max", "min", "close")))


@query(S.with_(S.BARS_SQL) + "--result SELECT symbol, date, CASE WHEN day(date) = 1 THEN NULL WHEN day(date) = 2 THEN close * 1.5::DOUBLE ELSE close END AS close, day(date) IN (1, 2) AS changed FROM bars", "close")
def q_apply_source_repair(spark, d):
    return C.apply_source_repair(bars(spark, d), better_source(spark, d)).select("symbol", "date", "close", "changed")


@query(S.with_(S.BARS_SQL) + """--result SELECT symbol, date, c AS "column", old, CASE WHEN day(date) = 2 THEN old * 1.5::DOUBLE END AS "new" FROM (UNPIVOT bars ON open, "max", "min", close INTO NAME c VALUE old) WHERE day(date) IN (1, 2)""", 'old "new"')
def q_repair_ledger(spark, d):
    x = bars(spark, d)
    return C.repair_ledger(x, C.apply_source_repair(x, better_source(spark, d)))


@query(S.with_(S.BARS_SQL) + "--result SELECT symbol, date, close AS close_a, close * 1.5::DOUBLE AS close_b FROM bars WHERE day(date) = 2", "close_a close_b")
def q_diff_frames(spark, d):
    x = bars(spark, d)
    y = C.apply_source_repair(x, better_source(spark, d)).where("close is not null")
    return C.diff_frames(x.where("dayofmonth(date) != 1"), y, ["symbol", "date"], ["close"])


# ---- universe ----------------------------------------------------------------

_SUPP = "WITH s AS (SELECT upper(replace(s_name, '#', '')) AS code, s_name AS name, 'T' || s_suppkey || ', T' || (s_suppkey + 1) || ',' AS tickers, s_nationkey AS k, s_suppkey AS n FROM supplier)"


def supplier_symbols(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(F.upper(F.replace("s_name", F.lit("#"), F.lit(""))).alias("code"), F.col("s_name").alias("name"), F.concat(F.lit("T"), k, F.lit(", T"), k + 1, F.lit(",")).alias("tickers"), F.col("s_nationkey").alias("k"), k.alias("n"))


@query(_SUPP + "--result SELECT code, trim(t) AS ticker FROM (SELECT code, unnest(string_split(tickers, ',')) AS t FROM s) WHERE trim(t) != ''")
def q_candidate_tickers(spark, d):
    return U.candidate_tickers(supplier_symbols(spark, d)).select("code", "ticker")


@query("WITH s AS (SELECT lpad((s_suppkey * 7 % 100000)::VARCHAR, 4, '0') || CASE WHEN s_suppkey % 5 = 0 THEN 'U' ELSE '' END AS code, s_name || CASE WHEN s_suppkey % 9 = 0 THEN '權證' ELSE '' END AS name, CASE WHEN s_suppkey % 4 = 0 THEN 'tw_delisted' ELSE 'listed' END AS market FROM supplier)--result SELECT code, name FROM s WHERE market = 'tw_delisted' OR regexp_full_match(code, '(?:[0-9]{4}[A-Z]?|00[0-9A-Z]{3,4})') AND NOT contains(name, '權證')")
def q_supported_universe(spark, d):
    k = F.col("s_suppkey")
    code = F.concat(F.lpad((k * 7 % 100000).cast("string"), 4, "0"), F.when(k % 5 == 0, "U").otherwise(""))
    x = table(spark, d, "supplier").select(code.alias("code"), F.concat("s_name", F.when(k % 9 == 0, "權證").otherwise("")).alias("name"), F.when(k % 4 == 0, "tw_delisted").otherwise("listed").alias("market"))
    return U.supported_universe(x).select("code", "name")


_TICK = ", t AS (SELECT code, 'T' || n AS ticker FROM s UNION ALL SELECT code, 'T' || (n + 1) FROM s), bl AS (SELECT 'T' || c_custkey AS ticker FROM customer WHERE c_custkey % 3 != 0)"


def black(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").where("c_custkey % 3 != 0").select(F.concat(F.lit("T"), F.col("c_custkey")).alias("ticker"))


@query(_SUPP + _TICK + "--result SELECT code, ticker FROM t WHERE ticker NOT IN (SELECT ticker FROM bl)")
def q_available_candidates(spark, d):
    return U.available_candidates(U.candidate_tickers(supplier_symbols(spark, d)).select("code", "ticker"), black(spark, d))


@query(_SUPP + _TICK + "--result SELECT code FROM t GROUP BY code HAVING bool_and(ticker IN (SELECT ticker FROM bl))")
def q_all_blacklisted(spark, d):
    return U.all_blacklisted(U.candidate_tickers(supplier_symbols(spark, d)).select("code", "ticker"), black(spark, d))


@query(
    _SUPP + """, x AS (SELECT code || CASE WHEN n % 7 = 0 THEN '_TW' ELSE '' END AS code, lower(tickers) AS tickers, CASE WHEN k % 3 = 0 THEN 'us_delisted' WHEN k % 3 = 1 THEN 'us' END AS market, n FROM s),
    t AS (SELECT code, upper(trim(t)) AS ticker FROM (SELECT code, unnest(string_split(tickers, ',')) AS t FROM x) WHERE trim(t) != ''),
    f AS (SELECT code, bool_or(substr(ticker, 2)::BIGINT % 4 = 0) AS a, bool_or(substr(ticker, 2)::BIGINT % 4 < 2) AS d FROM t GROUP BY code)
    --result SELECT code, CASE WHEN market = 'us_delisted' AND a AND NOT code LIKE '%\\_TW' ESCAPE '\\' THEN 'us' WHEN market IS DISTINCT FROM 'us_delisted' AND d AND NOT a THEN 'us_delisted' ELSE market END AS market FROM x JOIN f USING (code)"""
)
def q_apply_listing_state(spark, d):
    """Tickers of lists in upper case, of symbols in lower case; delisted, listed and unknown symbols, some of an archive."""
    k = F.col("k") % 3
    x = supplier_symbols(spark, d).select(F.concat("code", F.when(F.col("n") % 7 == 0, "_TW").otherwise("")).alias("code"), F.lower("tickers").alias("tickers"), F.when(k == 0, "us_delisted").when(k == 1, "us").alias("market"))
    every = U.candidate_tickers(x).select(F.upper("ticker").alias("ticker"), (F.substring("ticker", 2, 20).cast("long") % 4).alias("r")).distinct()
    return U.apply_listing_state(x, every.where("r = 0"), every.where("r < 2"), "us", "us_delisted").select("code", "market")


@query(_SUPP + "--result SELECT code FROM s WHERE n NOT IN (SELECT n FROM s WHERE k < 5)")
def q_new_symbols(spark, d):
    x = supplier_symbols(spark, d)
    return U.new_symbols(x, x.where("k < 5")).select("code")


@query(_SUPP + "--result SELECT code, min(p)::INT AS priority FROM (SELECT code, 0 AS p FROM s WHERE k = 1 UNION ALL SELECT code, 1 FROM s WHERE k < 4 UNION ALL SELECT code, 2 FROM s) GROUP BY code")
def q_prioritised_union(spark, d):
    x = supplier_symbols(spark, d).select("code", "k")
    return U.prioritised_union([x.where("k = 1"), x.where("k < 4"), x]).select("code", "priority")


@query(_SUPP + "--result SELECT code FROM s WHERE k < 10 AND k != 3")
def q_update_symbol_list(spark, d):
    x = supplier_symbols(spark, d).select("code", "k")
    return U.update_symbol_list(x.where("k < 5"), x.where("k < 10"), x.where("k = 3"))


# ---- edges and graphs ---------------------------------------------------------


def edges(spark: SparkSession, d: str) -> DataFrame:
    """Trade between nations: revenue from the supplier's to the customer's, one edge per market segment, written once for all uses."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", (F.col("l_extendedprice").cast("double") * (1 - F.col("l_discount").cast("double"))).alias("v"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.concat(F.lit("N"), F.col("s_nationkey")).alias("source"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("N"), F.col("c_nationkey")).alias("target"), F.col("c_mktsegment").alias("shock"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    x = lines.join(o, "l_orderkey").join(s, "l_suppkey").join(c, "o_custkey")
    return cut(x.groupBy("shock", "source", "target").agg((F.sum("v") / 1e6).alias("weight")))


_EDGES = "WITH edges AS MATERIALIZED (SELECT c_mktsegment AS shock, 'N' || s_nationkey AS source, 'N' || c_nationkey AS target, sum(l_extendedprice::DOUBLE * (1 - l_discount::DOUBLE)) / 1e6 AS weight FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN customer ON c_custkey = o_custkey GROUP BY ALL), flat AS MATERIALIZED (SELECT source, target, sum(weight) AS weight FROM edges GROUP BY ALL)"


def flat_edges(spark: SparkSession, d: str) -> DataFrame:
    return edges(spark, d).groupBy("source", "target").agg(F.sum("weight").alias("weight"))


@query(_EDGES + "--result SELECT source, target, sum(weight) AS total, avg(weight) AS mean, max(weight) AS max, count(*) AS shocks, arg_min(shock, (-weight, shock)) AS dominant_shock FROM edges GROUP BY ALL", "total mean max")
def q_aggregate_edges(spark, d):
    return G.aggregate_edges(edges(spark, d))


@query(_EDGES + "--result SELECT source, sum(weight) AS total, count(*) AS edges FROM flat GROUP BY source", "total")
def q_edge_summary(spark, d):
    return G.edge_summary(flat_edges(spark, d), "source")


@query(_EDGES + "--result SELECT source, target, weight FROM flat ORDER BY weight DESC, source, target LIMIT 20", "weight")
def q_top_edges(spark, d):
    return G.top_edges(flat_edges(spark, d), 20)


@query(
    _EDGES + """, x AS (SELECT * FROM flat WHERE source != target), u AS ((SELECT source, target, weight FROM x ORDER BY weight DESC, source, target LIMIT 33)
      UNION SELECT source, target, weight FROM x QUALIFY row_number() OVER (PARTITION BY source ORDER BY weight DESC, source, target) <= 2 UNION SELECT source, target, weight FROM x QUALIFY row_number() OVER (PARTITION BY target ORDER BY weight DESC, source, target) <= 2)
    --result SELECT * FROM u ORDER BY weight DESC, source, target LIMIT 100""",
    "weight",
)
def q_backbone_edges(spark, d):
    return G.backbone_edges(flat_edges(spark, d), 100)


_NODES = """, o AS (SELECT source AS node, sum(weight) AS out_degree FROM flat GROUP BY source), i AS (SELECT target AS node, sum(weight) AS in_degree FROM flat GROUP BY target),
  nodes AS MATERIALIZED (SELECT node, coalesce(out_degree, 0.0) AS out_degree, coalesce(in_degree, 0.0) AS in_degree, coalesce(out_degree, 0.0) / sum(coalesce(out_degree, 0.0)) OVER () AS hub_share, coalesce(in_degree, 0.0) / sum(coalesce(in_degree, 0.0)) OVER () AS authority_share, coalesce(out_degree, 0.0) - coalesce(in_degree, 0.0) AS net_score FROM o FULL JOIN i USING (node))"""


@query(_EDGES + _NODES + "--result SELECT * FROM nodes", "out_degree in_degree hub_share authority_share net_score")
def q_node_metrics(spark, d):
    return G.node_metrics(flat_edges(spark, d))


@query(
    _EDGES + _NODES + """, q AS (SELECT quantile_cont(out_degree, 0.75) AS o, quantile_cont(in_degree, 0.75) AS i, quantile_cont(hub_share, 0.75) AS h, quantile_cont(authority_share, 0.75) AS a FROM nodes)
    --result SELECT node, CASE WHEN out_degree >= o AND hub_share >= h THEN 'transmitter' WHEN in_degree >= i AND authority_share >= a THEN 'receiver' WHEN out_degree > in_degree THEN 'net_source' WHEN in_degree > out_degree THEN 'net_sink' ELSE 'balanced' END AS role FROM nodes, q"""
)
def q_assign_roles(spark, d):
    return G.assign_roles(G.node_metrics(flat_edges(spark, d))).select("node", "role")


def communities(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("node"), F.col("n_regionkey").alias("community"))


@query(_EDGES + "--result SELECT a.n_regionkey AS source_community, b.n_regionkey AS target_community, sum(weight) AS weight, count(*) AS edges FROM flat JOIN nation a ON source = 'N' || a.n_nationkey JOIN nation b ON target = 'N' || b.n_nationkey GROUP BY ALL", "weight")
def q_community_flow(spark, d):
    return G.community_flow(flat_edges(spark, d), communities(spark, d))


@query(_EDGES + _NODES + """, c AS (SELECT 'N' || n_nationkey AS node, n_regionkey AS community FROM nation), f AS (SELECT a.community AS s, b.community AS t, sum(weight) AS w FROM flat JOIN c a ON a.node = source JOIN c b ON b.node = target GROUP BY ALL)
    --result SELECT c.community, count(*) AS members, coalesce(sum(hub_share), 0) AS total_rank, coalesce(sum(hub_share), 0) AS total_hub_share, coalesce(sum(authority_share), 0) AS total_authority_share, coalesce(sum(out_degree), 0) AS total_out_degree, coalesce(sum(in_degree), 0) AS total_in_degree, string_agg(c.node, ',' ORDER BY hub_share DESC NULLS LAST, c.node) AS top_members, coalesce((SELECT sum(w) FROM f WHERE s = c.community AND t = c.community), 0) AS internal,
      coalesce((SELECT sum(w) FROM f WHERE s = c.community AND t != c.community), 0) AS outgoing, coalesce((SELECT sum(w) FROM f WHERE t = c.community AND s != c.community), 0) AS incoming FROM c LEFT JOIN nodes USING (node) GROUP BY c.community""", 'total_rank total_hub_share total_authority_share total_out_degree total_in_degree internal outgoing incoming')
def q_community_summary(spark, d):
    e = flat_edges(spark, d)
    return G.community_summary(e, communities(spark, d), G.node_metrics(e).select("node", F.col("hub_share").alias("rank"), "hub_share", "authority_share", "out_degree", "in_degree"))


_DENSE = _EDGES.replace("WITH", "WITH RECURSIVE", 1) + """, v AS MATERIALIZED (SELECT node, row_number() OVER (ORDER BY node) AS i, count(*) OVER () AS n FROM (SELECT source AS node FROM flat UNION SELECT target FROM flat)),
  cells AS (SELECT a.i AS s, b.i AS t, coalesce(f.weight, 0.0)::DOUBLE AS w FROM v a CROSS JOIN v b LEFT JOIN flat f ON f.source = a.node AND f.target = b.node),
  shares AS (SELECT s, t, w, CASE WHEN sum(w) OVER (PARTITION BY s) > 0 THEN w / sum(w) OVER (PARTITION BY s) ELSE 0 END AS p, sum(w) OVER (PARTITION BY s) AS total FROM cells),
  whole AS MATERIALIZED (
    SELECT (SELECT list(r ORDER BY t) FROM (SELECT t, list(p ORDER BY s) AS r FROM shares GROUP BY t)) AS share_in, (SELECT list(r ORDER BY t) FROM (SELECT t, list(w ORDER BY s) AS r FROM cells GROUP BY t)) AS weight_in,
      (SELECT list(r ORDER BY s) FROM (SELECT s, list(w ORDER BY t) AS r FROM cells GROUP BY s)) AS weight_out, (SELECT list(CASE WHEN total > 0 THEN 0.0 ELSE 1.0 END::DOUBLE ORDER BY s) FROM (SELECT DISTINCT s, total FROM shares)) AS loose, (SELECT max(n) FROM v) AS n)"""


@query(
    _DENSE + """, walk(k, x) AS (
      SELECT 0, list_transform(range(n), lambda j: 1.0::DOUBLE / n) FROM whole
      UNION ALL SELECT k + 1, list_transform(share_in, lambda r: 0.15::DOUBLE / n + 0.85::DOUBLE * (list_inner_product(r, x) + list_inner_product(loose, x) / n)) FROM walk, whole WHERE k < 200)
    --result SELECT node, x[i] AS rank FROM walk, v WHERE k = 200""",
    "rank",
)
def q_pagerank(spark, d):
    return G.pagerank(flat_edges(spark, d))


@query(
    _DENSE + """, walk(k, h, a) AS (
      SELECT 0, list_transform(range(n), lambda j: 1.0::DOUBLE), list_transform(range(n), lambda j: 0.0::DOUBLE) FROM whole
      UNION ALL
      SELECT k + 1, list_transform(y, lambda e: e / list_sum(y)), b FROM (
        SELECT k, b, list_transform(weight_out, lambda r: list_inner_product(r, b)) AS y FROM (
          SELECT k, weight_out, list_transform(z, lambda e: e / list_sum(z)) AS b FROM (SELECT k, weight_out, list_transform(weight_in, lambda r: list_inner_product(r, h)) AS z FROM walk, whole WHERE k < 150))))
    --result SELECT node, h[i] AS hub, a[i] AS authority FROM walk, v WHERE k = 150""",
    "hub authority",
)
def q_hits(spark, d):
    return G.hits(flat_edges(spark, d))


@query(
    _DENSE + """, walk(k, x) AS (
      SELECT 0, list_transform(range(n), lambda j: 1.0::DOUBLE) FROM whole
      UNION ALL SELECT k + 1, list_transform(y, lambda e: e / sqrt(list_inner_product(y, y))) FROM (SELECT k, list_transform(list_zip(x, weight_in), lambda z: z[1] + list_inner_product(z[2], x)) AS y FROM walk, whole WHERE k < 200))
    --result SELECT node, x[i] AS centrality FROM walk, v WHERE k = 200""",
    "centrality",
)
def q_eigenvector(spark, d):
    return G.eigenvector(flat_edges(spark, d))


def trade_lines(spark: SparkSession, d: str) -> DataFrame:
    """Every order line as numbered nodes: its customer, supplier and part, and whether it came back."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_returnflag")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(o, "l_orderkey").select((F.col("o_custkey") * 3).alias("customer"), (F.col("l_suppkey") * 3 + 1).alias("supplier"), (F.col("l_partkey") * 3 + 2).alias("part"), (F.col("l_returnflag") == "R").alias("returned"))


def trade_edges(spark: SparkSession, d: str) -> DataFrame:
    """Customers and the suppliers of their orders, as often as they met."""
    return trade_lines(spark, d).select(F.col("customer").alias("source"), F.col("supplier").alias("target"))


def shipment_edges(spark: SparkSession, d: str) -> DataFrame:
    """The same, by where the goods went: to the customer, and back to the supplier if they were returned."""
    c, s = F.col("customer"), F.col("supplier")
    way = lambda a, b: F.struct(a.alias("source"), b.alias("target"))
    return trade_lines(spark, d).select(F.inline(F.when(F.col("returned"), F.array(way(s, c), way(c, s))).otherwise(F.array(way(s, c)))))


def part_edges(spark: SparkSession, d: str) -> DataFrame:
    """Customers, suppliers and parts that meet in an order line, as often as they do."""
    ends = [("customer", "supplier"), ("customer", "part"), ("supplier", "part")]
    links = F.array(*(F.struct(F.col(a).alias("source"), F.col(b).alias("target")) for a, b in ends))
    return trade_lines(spark, d).select(F.inline(links))


_TRADE = """WITH RECURSIVE trade AS (SELECT o_custkey * 3 AS c, l_suppkey * 3 + 1 AS s, l_returnflag = 'R' AS back FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
  both_ways AS MATERIALIZED (SELECT c AS a, s AS b FROM trade UNION SELECT s, c FROM trade)"""


@query(
    _TRADE + """, loops AS MATERIALIZED (FROM both_ways UNION SELECT a, a FROM both_ways),
    walk(node, component, k) AS (SELECT DISTINCT a, a, 0 FROM loops UNION ALL SELECT l.b, min(w.component), w.k + 1 FROM walk w JOIN loops l ON l.a = w.node WHERE w.k < 20 GROUP BY l.b, w.k)
    --result SELECT node, component FROM walk WHERE k = 20"""
)
def q_weak_components(spark, d):
    return G.weak_components(trade_edges(spark, d))


@query(
    _EDGES + """, e AS (SELECT DISTINCT least(source, target) AS a, greatest(source, target) AS b FROM flat WHERE source != target),
    t AS (SELECT x.a, x.b, y.b AS c FROM e x JOIN e y ON x.b = y.a JOIN e z ON z.a = x.a AND z.b = y.b), n AS (SELECT a AS node FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t), v AS (SELECT source AS node FROM flat UNION SELECT target FROM flat)
    --result SELECT v.node, count(n.node) AS triangles FROM v LEFT JOIN n USING (node) GROUP BY v.node"""
)
def q_triangle_count(spark, d):
    return G.triangle_count(flat_edges(spark, d))


@query()
def q_trade_triangles(spark, d):
    return G.triangle_count(part_edges(spark, d))


@query(
    _TRADE + """, walk(node, core, k) AS (
      SELECT a, count(*)::BIGINT, 0 FROM both_ways GROUP BY a
      UNION ALL
      SELECT node, max(least(core, reach))::BIGINT, k + 1 FROM (
        SELECT node, core, k, sum(n) OVER (PARTITION BY node ORDER BY core DESC) AS reach FROM (SELECT b.a AS node, w.core, w.k, count(*) AS n FROM walk w JOIN both_ways b ON b.b = w.node WHERE w.k < 80 GROUP BY ALL))
      GROUP BY node, k)
    --result SELECT node, core::INT AS core FROM walk WHERE k = 80"""
)
def q_core_number(spark, d):
    return G.core_number(trade_edges(spark, d))


@query(
    _TRADE + """, ways AS MATERIALIZED (SELECT s AS a, c AS b FROM trade UNION SELECT c, s FROM trade WHERE back),
    reach(a, b) AS (SELECT a, a FROM ways UNION SELECT b, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b)
    --result SELECT x.a AS node, min(x.b) AS component FROM reach x JOIN reach y ON y.a = x.b AND y.b = x.a GROUP BY x.a"""
)
def q_strong_components(spark, d):
    return G.strong_components(shipment_edges(spark, d))


@query(
    S.with_(*S.PANEL) + f"""--result SELECT * FROM (SELECT {', '.join(f"CASE WHEN count(*) FILTER ({f} IS NOT NULL AND return_1d IS NOT NULL) >= 3 THEN corr({f}, return_1d) ELSE 0 END AS {f}" for f in ('close_logret_1d', 'clv_centered', 'body_ratio'))} FROM feats) UNPIVOT (correlation FOR feature IN (close_logret_1d, clv_centered, body_ratio))""",
    "correlation",
)
def q_feature_correlation(spark, d):
    return A.feature_correlation(panel(spark, d), ["close_logret_1d", "clv_centered", "body_ratio"], ["return_1d"]).select("feature", "correlation")


@query(
    "WITH x AS (SELECT unnest(embedding)::DOUBLE AS x FROM embeddings)--result SELECT avg(x) AS mean, stddev_pop(x) AS std, avg(abs(x)) AS mean_abs, max(abs(x)) AS max_abs, avg((abs(x) < 1e-8)::INT) AS zero_share, avg((x IS NOT NULL AND isfinite(x))::INT) AS finite_share FROM x",
    "mean std mean_abs max_abs zero_share finite_share",
)
def q_aux_summary(spark, d):
    return A.aux_summary(table(spark, d, "embeddings"), "embedding")


@query(
    "WITH x AS (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings), m AS (SELECT i::INT AS dimension, avg(abs(x)) AS mean_abs FROM x GROUP BY i)--result SELECT dimension, mean_abs, mean_abs / sum(mean_abs) OVER () AS share FROM m",
    "mean_abs share",
)
def q_aux_dimensions(spark, d):
    return A.aux_dimensions(table(spark, d, "embeddings"), "embedding")


@query()
def q_pca_2d(spark, d):
    x = A.pca_2d(table(spark, d, "embeddings"), "embedding")
    return x.select("vec_id", F.abs("pc1").alias("pc1"), F.abs("pc2").alias("pc2"), "norm")


@query(_EDGES + "--result SELECT shock, sum(weight) AS value, sum(weight) / (SELECT sum(weight) FROM edges) AS share FROM edges GROUP BY shock", "value share")
def q_shares(spark, d):
    return A.shares(edges(spark, d).withColumnRenamed("weight", "value"), "shock")


@query(
    _EDGES + """, f AS (SELECT shock, source, sum(weight) AS share FROM edges GROUP BY ALL), r AS (SELECT *, rank() OVER (PARTITION BY shock ORDER BY share DESC) AS rank FROM f)
    --result SELECT source AS feature, count(DISTINCT shock) AS folds, avg(rank) AS mean_rank, stddev_samp(rank) AS std_rank, avg(share) AS mean_share, stddev_samp(share) AS std_share FROM r GROUP BY source""",
    "mean_rank std_rank mean_share std_share",
)
def q_fold_stability(spark, d):
    x = edges(spark, d).groupBy(F.col("shock").alias("fold_id"), F.col("source").alias("feature")).agg(F.sum("weight").alias("share"))
    return A.fold_stability(x)


@query(
    _EDGES + """, a AS (SELECT source, sum(weight) AS share FROM edges WHERE shock = 'BUILDING' GROUP BY source), b AS (SELECT source, max(weight) AS share FROM edges WHERE shock != 'BUILDING' GROUP BY source)
    --result SELECT source, coalesce(a.share, 0.0) AS one, coalesce(b.share, 0.0) AS two, (coalesce(a.share, 0.0) + coalesce(b.share, 0.0)) / 2 AS mean_share FROM a FULL JOIN b USING (source)""",
    "one two mean_share",
)
def q_attribution_table(spark, d):
    e = edges(spark, d)
    a = e.where("shock = 'BUILDING'").groupBy("source").agg(F.sum("weight").alias("share"))
    b = e.where("shock != 'BUILDING'").groupBy("source").agg(F.max("weight").alias("share"))
    return A.attribution_table({"one": a, "two": b}, ["source"])


@query(_EDGES + "--result SELECT source, sum(weight * c) / sum(c) AS weight, sum(c)::BIGINT AS rows FROM (SELECT *, length(shock) AS c FROM edges) GROUP BY source", "weight")
def q_combine_chunks(spark, d):
    return A.combine_chunks(edges(spark, d).withColumn("rows", F.length("shock").cast("long")), ["source"], ["weight"])


@query(_EDGES + "--result SELECT source, sum(weight) AS total FROM edges GROUP BY source ORDER BY 2 DESC, 1 LIMIT 5", "total")
def q_top_groups(spark, d):
    return A.top_groups_by_sum(edges(spark, d), "source", "weight", 5)


@query(S.with_(*S.PANEL) + f"--result SELECT date, {', '.join(f'''max(close) FILTER (symbol = 'N{i}') AS N{i}''' for i in range(25))} FROM feats GROUP BY date", " ".join(f"N{i}" for i in range(25)))
def q_wide_weights(spark, d):
    return files.wide_weights(bars(spark, d).select("date", "symbol", F.col("close").alias("weight")), [f"N{i}" for i in range(25)])


# ---- models -------------------------------------------------------------------

MODEL = ["close_logret_1d", "clv_centered", "body_ratio", "shadow_imbalance"]


@query()
def q_ridge_scores(spark, d):
    x = panel(spark, d)
    train, test = x.where("year(date) < 2000"), x.where("year(date) >= 2000")
    return A.score_panel(A.ridge(A.training_matrix(train, MODEL)), A.training_matrix(test, MODEL)).select("date", "symbol", "score", "label")


@query()
def q_boosted_scores(spark, d):
    x = panel(spark, d)
    return A.score_panel(A.boosted_trees(A.training_matrix(x.where("year(date) < 2000"), MODEL), 3, 3), A.training_matrix(x.where("year(date) >= 2000"), MODEL)).select("date", "symbol", "score", "label")


@query()
def q_zero_importance(spark, d):
    x = panel(spark, d).fillna(0.0, MODEL)
    model = A.elastic_net(A.training_matrix(x, MODEL), 1e-6)
    return A.zero_feature_importance(model, x.where("tradable"), MODEL)


# ---- landed payloads, ticks, streams -----------------------------------------


@query(
    S.with_(S.BARS_SQL) + """--result SELECT symbol, date::TIMESTAMP AS date, open, "max", "min", close, adjclose, "Trading_Volume" FROM bars""", RAW
)
def q_candle_payload(spark, d):
    """Bars turned to landed JSON candles of a month each, and parsed again."""
    x = bars(spark, d).withColumn("ms", F.unix_millis(F.col("date").cast("timestamp")))
    text = lambda c: F.col(c).cast("string")
    landed = x.groupBy("symbol", F.trunc("date", "month").alias("m")).agg(F.to_json(F.collect_list(F.array(text("ms"), text("open"), text("max"), text("min"), text("close"), text("Trading_Volume"), F.lit("")))).alias("payload")).withColumn("ingest_seq", F.lit(1))
    return files.normalize_bybit_candles(landed).select("symbol", "date", "open", "max", "min", "close", "adjclose", "Trading_Volume")


@query(S.with_(S.BARS_SQL) + """--result SELECT 'USD' || symbol AS symbol, date, close AS open, close FROM bars WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""", "open close")
def q_rate_payload(spark, d):
    """Closes turned to a landed JSON object of rates by day, and parsed again."""
    day = bars(spark, d).groupBy("date").agg(F.map_from_entries(F.collect_list(F.struct("symbol", "close"))).alias("rates"))
    landed = day.select(F.lit(1).alias("ingest_seq"), F.to_json(F.map_from_arrays(F.array(F.col("date").cast("string")), F.array("rates"))).alias("payload"))
    return files.rates_to_bars(files.parse_rate_payload(landed), "USD", "1996-01-01", "1999-12-31").select("symbol", "date", "open", "close")


def ticks(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.concat(F.lit("U"), F.col("user_id") % 40).alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), F.col("value").cast("double").alias("price"), F.lit(1.0).alias("size"))


@query(
    """WITH t AS (SELECT 'U' || (user_id % 40) AS symbol, time_bucket(INTERVAL 15 MINUTE, ts) AS date, (ts, event_id) AS o, value::DOUBLE AS price FROM events)
    --result SELECT symbol, date, arg_min(price, o) AS open, max(price) AS max, min(price) AS min, arg_max(price, o) AS close, count(*)::DOUBLE AS "Trading_Volume", count(*) AS ticks FROM t GROUP BY symbol, date""",
    'open "max" "min" close "Trading_Volume"',
)
def q_interval_bars(spark, d):
    return ST.interval_bars(ticks(spark, d)).withColumn("date", F.col("date").cast("timestamp_ntz"))


@query(
    """WITH t AS (SELECT 'U' || (user_id % 40) AS symbol, ts, event_id FROM events)--result SELECT symbol, min(ts)::TIMESTAMP AS first_tick, max(ts)::TIMESTAMP AS last_tick, count(*) AS n FROM t GROUP BY symbol"""
)
def q_tick_coverage(spark, d):
    return ticks(spark, d).groupBy("symbol").agg(F.min("ts").cast("timestamp_ntz").alias("first_tick"), F.max("ts").cast("timestamp_ntz").alias("last_tick"), F.count("*").alias("n"))


@query()
def q_source_fingerprint(spark, d):
    return files.source_fingerprint(spark, f"{d}/lineitem.parquet")


@query(
    """WITH f AS (SELECT DISTINCT unnest(['close_logret_1d', 'Volume_' || p_size, 'body_ratio', 'upper_shadow', 'range_' || p_size, 'p' || p_size]) AS feature FROM part)
    --result SELECT feature, CASE WHEN lower(feature) LIKE '%logret%' THEN 'Return' WHEN lower(feature) LIKE '%vol%' THEN 'Volume' WHEN lower(feature) LIKE '%body%' THEN 'Candlestick' WHEN lower(feature) LIKE '%shadow%' THEN 'Shadow' WHEN lower(feature) LIKE '%range%' THEN 'Position' ELSE 'Other' END || ' / ' || feature AS label FROM f"""
)
def q_feature_labels(spark, d):
    n = F.col("p_size").cast("string")
    names = F.array(F.lit("close_logret_1d"), F.concat(F.lit("Volume_"), n), F.lit("body_ratio"), F.lit("upper_shadow"), F.concat(F.lit("range_"), n), F.concat(F.lit("p"), n))
    return table(spark, d, "part").select(F.explode(names).alias("feature")).distinct().select("feature", X.feature_label(F.col("feature")).alias("label"))


@query("--result SELECT DISTINCT o_orderdate::DATE AS day, (o_orderdate::DATE - CASE isodow(o_orderdate) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END)::DATE AS weekday FROM orders")
def q_previous_weekday(spark, d):
    x = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return x.select("day", X.previous_weekday(F.col("day")).alias("weekday"))


@query(
    """WITH t AS (SELECT 'S' || (o_custkey % 7) AS symbol, o_orderkey AS k FROM orders), m AS (SELECT symbol FROM t GROUP BY symbol HAVING symbol IN ('S1', 'S2'))
    --result SELECT symbol, k, 'manual_review_no_change' AS repair_method, 'look at ' || symbol AS repair_reason FROM t JOIN m USING (symbol) UNION ALL SELECT symbol, k, 'unclassified_no_change', 'No curated repair rule yet; inspect before mutating source data.' FROM t WHERE symbol NOT IN ('S1', 'S2', 'S3')"""
)
def q_review_queue(spark, d):
    t = table(spark, d, "orders").select(F.concat(F.lit("S"), F.col("o_custkey") % 7).alias("symbol"), F.col("o_orderkey").alias("k"))
    symbols = t.select("symbol").distinct()
    manual = symbols.where("symbol in ('S1', 'S2')").withColumn("reason", F.concat(F.lit("look at "), "symbol"))
    return C.review_queue(t, symbols.where("symbol = 'S3'"), manual)


@query(S.with_(S.BARS_SQL) + """, w AS (SELECT symbol, date, CAST(substr(symbol, 2) AS INT) % 2 = 1 AS odd FROM bars), r AS (SELECT CASE WHEN odd AND date BETWEEN DATE '1998-02-01' AND DATE '1998-02-28' THEN 'scale' WHEN NOT odd AND date IN (DATE '1997-03-03', DATE '1997-03-10') THEN 'neighbour' END AS method FROM w)--result SELECT method, count(*) AS count FROM r WHERE method IS NOT NULL GROUP BY method""")
def q_method_counts(spark, d):
    return C.method_counts(C.apply_repair_rules(bars(spark, d), repair_rules(spark, d)))


@query(_EDGES + "--result SELECT source, target, sum(weight) AS total FROM edges GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 12", "total")
def q_top_cells(spark, d):
    return A.top_cells(edges(spark, d), "source", "target", "weight", 12)
