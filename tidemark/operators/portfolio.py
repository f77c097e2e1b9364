"""Ranks, weights, profit and loss, and performance of books over a panel."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidemark.functions.scratch import cut
from tidemark.functions.expressions import clean, finite, safe_expm1, softplus

def day_window() -> WindowSpec:
    return Window.partitionBy("date")

def run_window() -> WindowSpec:
    return Window.partitionBy("run_id").orderBy("date")

def book_window() -> WindowSpec:
    return Window.partitionBy("run_id", "symbol").orderBy("date")

YEAR_DAYS = 252


def align_panel(bars: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Every date of the panel for every symbol; days without a bar have nulls.

    Both sides of the product are dimensions (days and symbols), and the
    product is the dense panel itself; it is needed for turnover only.
    """
    dates, symbols = bars.select("date").distinct(), bars.select("symbol").distinct()
    return dates.crossJoin(symbols).join(bars, ["date", "symbol"], "left")


def cross_section_rank(panel: DataFrame, value: str, name: str, valid: Column | None = None) -> DataFrame:
    """Ordinal rank within the day, from 1; ties by symbol; null where `valid` is false."""
    ok = F.col(value).isNotNull() if valid is None else valid
    return panel.withColumn(name, F.when(ok, F.row_number().over(Window.partitionBy("date", ok).orderBy(F.col(value), F.col("symbol")))))


def rank_position(panel: DataFrame, score: str, name: str, valid: Column) -> DataFrame:
    """Place of each symbol in the day's descending order of scores, from 0; symbols that are not valid get the number of symbols."""
    order = Window.partitionBy("date", valid).orderBy(F.desc_nulls_last(score), "symbol")
    return panel.withColumn(name, F.when(valid, F.row_number().over(order) - 1).otherwise(F.count("*").over(day_window())))


def universe_average(panel: DataFrame) -> DataFrame:
    return panel.groupBy("date").agg(F.coalesce(F.avg("return_1d"), F.lit(0.0)).alias("benchmark_return"))


def universe_cumulative(panel: DataFrame) -> DataFrame:
    return panel.groupBy("date").agg(F.coalesce(F.sum(F.when(F.col("tradable"), F.col("return_1d"))), F.lit(0.0)).alias("total_return"))


def top_k_equal_weight(panel: DataFrame, score: str, k: int) -> DataFrame:
    """(date, symbol, weight) of the k best tradable scores of each day; ties go to the higher symbol."""
    ok = panel.where(F.col("tradable") & finite(F.col(score)).isNotNull())
    best = ok.withColumn("r", F.row_number().over(day_window().orderBy(F.desc(score), F.desc("symbol")))).where(F.col("r") <= k)
    return best.withColumn("weight", F.lit(1.0) / F.count("*").over(day_window())).select("date", "symbol", "weight")


def normalize_weights(scores: DataFrame, score: str, long_only: bool, leverage: float = 1.0, mask: Column | None = None, bound: float | None = None) -> DataFrame:
    """`scores` with weight: tanh, no shorts if long only, divided by the day's gross, times the budget."""
    budget = min(max(leverage, 0.0), 1.0)
    x = F.tanh(clean(F.col(score), bound) if bound else F.coalesce(F.col(score), F.lit(0.0)))
    x = F.greatest(x, F.lit(0.0)) if long_only else x
    x = F.when(mask, x).otherwise(0.0) if mask is not None else x
    out = scores.withColumn("_x", x)
    return out.withColumn("weight", F.col("_x") / F.greatest(F.sum(F.abs("_x")).over(day_window()), F.lit(1e-12)) * budget).drop("_x")


def masked_softmax(scores: DataFrame, score: str, mask: Column) -> DataFrame:
    x = F.when(mask, F.col(score))
    out = scores.withColumn("_e", F.exp(x - F.max(x).over(day_window())))
    return out.withColumn("weight", F.coalesce(F.col("_e") / F.sum("_e").over(day_window()), F.lit(0.0))).drop("_e")


def carry(weights: DataFrame) -> DataFrame:
    """Realised weights if a symbol that can't be traded keeps yesterday's; `weights` is dense."""
    held = F.last(F.when(F.col("tradable"), F.col("weight")), ignorenulls=True).over(book_window().rowsBetween(Window.unboundedPreceding, 0))
    return weights.withColumn("weight", F.coalesce(held, F.lit(0.0)))


#: Days that one block of a fold holds.
BLOCK_DAYS = 64


def side_masks(weights: DataFrame, block: int = BLOCK_DAYS) -> DataFrame:
    """Realised weights if increases need can_buy and decreases can_sell: a fold along each symbol's days.

    A day moves what is held to its target, only up, only down, or not at all:
    it bounds the state from below or above or both.  Bounds of following days
    make up bounds again, so each block of days is one pair of bounds; the
    state at a block's start comes from the pairs of the blocks before it, and
    the days within a block are folded apart.  No array grows by the day over
    more than a block.
    """
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    place = F.row_number().over(Window.partitionBy("run_id", "symbol").orderBy("date")) - 1
    day = F.struct("date", F.coalesce(F.col("weight"), F.lit(0.0)).alias("target"), F.coalesce("can_buy", F.lit(False)).alias("up"), F.coalesce("can_sell", F.lit(False)).alias("down"))
    blocks = weights.select("run_id", "symbol", F.floor(place / block).alias("_b"), day.alias("_day")).groupBy("run_id", "symbol", "_b").agg(F.array_sort(F.collect_list("_day")).alias("days"))

    def bounded(at: Column, d: Column) -> Column:
        return F.when((d["target"] > at) & d["up"] | (d["target"] < at) & d["down"], d["target"]).otherwise(at)

    # what a block makes of the least and the greatest possible state
    ends = F.struct(*(F.aggregate("days", start, bounded).alias(n) for n, start in (("low", low), ("high", high))))
    series = blocks.groupBy("run_id", "symbol").agg(F.array_sort(F.collect_list(F.struct("_b", ends.alias("ends"), "days"))).alias("blocks"))
    none = F.struct(F.lit(0.0).alias("at"), F.array().cast("array<double>").alias("out"))

    def enter(state: Column, b: Column) -> Column:
        now = F.greatest(F.least(state["at"], b["ends"]["high"]), b["ends"]["low"])
        return F.struct(now.alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

    starts = F.aggregate("blocks", none, enter, lambda s: s["out"])
    opened = series.select("run_id", "symbol", F.explode(F.arrays_zip(starts.alias("at"), F.col("blocks").alias("block"))).alias("e")).select("run_id", "symbol", F.col("e.at").alias("at"), F.col("e.block.days").alias("days"))
    within = F.struct(F.col("at").alias("at"), F.array().cast("array<struct<date:date,weight:double>>").alias("out"))

    def step(state: Column, d: Column) -> Column:
        now = bounded(state["at"], d)
        return F.struct(now.alias("at"), F.concat(state["out"], F.array(F.struct(d["date"].alias("date"), now.alias("weight")))).alias("out"))

    realised = opened.select("run_id", "symbol", F.explode(F.aggregate("days", within, step, lambda s: s["out"])).alias("d"))
    return weights.drop("weight").join(realised.select("run_id", "symbol", "d.date", "d.weight"), ["run_id", "symbol", "date"])


def portfolio_daily(weights: DataFrame, buy_fee: float = 0.0, sell_fee: float = 0.0) -> DataFrame:
    """Per run and day: gross, fees paid and turnover; weights (run_id, date, symbol, weight, return_1d) are dense."""
    w = F.coalesce(F.col("weight"), F.lit(0.0))
    out = weights.withColumn("_d", w - F.lag(w, 1, 0.0).over(book_window())).withColumn("_w", w)
    day = out.groupBy("run_id", "date").agg(
        F.sum(F.col("_w") * F.coalesce("return_1d", F.lit(0.0))).alias("gross_return"),
        F.sum(F.greatest("_d", F.lit(0.0))).alias("buy_turnover"),
        F.sum(F.greatest(-F.col("_d"), F.lit(0.0))).alias("sell_turnover"),
    )
    return day.withColumns(
        {"strategy_return": F.col("gross_return") - buy_fee * F.col("buy_turnover") - sell_fee * F.col("sell_turnover"), "turnover": F.col("buy_turnover") + F.col("sell_turnover")}
    )


def lagged_daily(weights: DataFrame, fee: float = 0.0) -> DataFrame:
    """Trade one day later: yesterday's long-only weights, normalised, with one fee on turnover."""
    x = F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)), F.lit(0.0))
    share = x / F.greatest(F.sum(x).over(Window.partitionBy("run_id", "date")), F.lit(1e-12))
    out = weights.withColumn("_s", share).withColumn("_w", F.lag("_s", 1, 0.0).over(book_window())).withColumn("_p", F.lag("_s", 2, 0.0).over(book_window()))
    day = out.groupBy("run_id", "date").agg(F.sum(F.col("_w") * F.coalesce("return_1d", F.lit(0.0))).alias("gross_return"), F.sum(F.abs(F.col("_w") - F.col("_p"))).alias("turnover"))
    return day.withColumn("strategy_return", F.col("gross_return") - fee * F.col("turnover"))


def policy_reward(weights: DataFrame, fee: float = 0.0, long_only: bool = True) -> DataFrame:
    """Reward of a policy over tradable symbols: return of normalised weights less fee times turnover.

    Long only: shorts are cut, and a day without weight is spread evenly over
    its tradable symbols.  Else weights are divided by their gross, and a day
    without weight stays empty.
    """
    day = Window.partitionBy("run_id", "date")
    ok = F.coalesce("tradable", F.lit(False))
    x = F.when(ok, F.coalesce(finite(F.col("weight")), F.lit(0.0))).otherwise(0.0)
    x = F.greatest(x, F.lit(0.0)) if long_only else x
    out = weights.withColumn("_x", x).withColumn("_g", F.sum(F.abs("_x")).over(day)).withColumn("_n", F.count_if(ok).over(day))
    empty = F.when(ok, 1.0 / F.nullif("_n", F.lit(0))).otherwise(0.0) if long_only else F.lit(0.0)
    out = out.withColumn("_w", F.when(F.col("_g") > 1e-8, F.col("_x") / F.col("_g")).otherwise(empty))
    out = out.withColumn("_d", F.abs(F.col("_w") - F.lag("_w", 1, 0.0).over(book_window())))
    agg = out.groupBy("run_id", "date").agg(F.sum(F.col("_w") * F.coalesce("return_1d", F.lit(0.0))).alias("gross_return"), F.sum("_d").alias("turnover"))
    return agg.withColumn("reward", F.col("gross_return") - fee * F.col("turnover"))


def constraint_check(weights: DataFrame, turnover_cap: float | None, gross_cap: float = 1.0, budget: float = 1.0) -> DataFrame:
    """(run_id, first_violation): the first day on which a cap binds on realised weights; null if none does."""
    cap = None if turnover_cap is None or turnover_cap >= 2 * budget else turnover_cap
    w = F.coalesce(F.col("weight"), F.lit(0.0))
    day = weights.withColumn("_w", w).withColumn("_d", F.abs(w - F.lag(w, 1, 0.0).over(book_window()))).groupBy("run_id", "date").agg(F.sum("_d").alias("t"), F.sum(F.abs("_w")).alias("g"))
    broken = F.col("g") > gross_cap + 1e-9
    broken = broken | (F.col("t") > cap + 1e-9) if cap is not None else broken
    return day.groupBy("run_id").agg(F.min(F.when(broken, F.col("date"))).alias("first_violation"))


def constrained_replay(weights: DataFrame, turnover_cap: float, long_only: bool = False, gross_cap: float = 1.0, start: DataFrame | None = None) -> DataFrame:
    """Realised (run_id, date, symbol, weight) where caps bind, day after day, for each run on its own.

    start: (run_id, symbol, weight) held before the first day, as `end_weights`
    gives them; nothing is held without it.

    Sells come first; buys are scaled to the cash left (long only), the day's
    trades to the turnover cap, and buys once more to the gross cap.  Rows of
    a run are read in date order and one day's book is held at a time.
    """
    schema = "run_id string, date date, symbol string, weight double"

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, float] = {}
        rest = None
        for batch in batches:
            before = batch["date"].isna()
            held.update(((r, s), w) for r, s, w in batch.loc[before, ["run_id", "symbol", "weight"]].fillna({"weight": 0.0}).itertuples(index=False))
            batch = batch[~before]
            if batch.empty:
                continue
            now = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = now[["run_id", "date"]].iloc[-1]
            cut = (now["run_id"] == last["run_id"]) & (now["date"] == last["date"])
            rest = now[cut]
            for part in _days(now[~cut], held):
                yield part
        if rest is not None:
            yield from _days(rest, held)

    def _days(rows: pd.DataFrame, held: dict) -> Iterator[pd.DataFrame]:
        for (run, _), day in rows.groupby(["run_id", "date"], sort=False):
            old = day["symbol"].map(lambda s, run=run: held.get((run, s), 0.0)).to_numpy()
            move = day["weight"].fillna(0.0).to_numpy() - old
            move[(move > 0) & ~day["can_buy"].to_numpy(dtype=bool)] = 0.0
            move[(move < 0) & ~day["can_sell"].to_numpy(dtype=bool)] = 0.0
            if long_only:
                move = move.clip(min=-old)
                left = 1.0 - (old.sum() + move[move < 0].sum())
                buys = move[move > 0].sum()
                if buys > max(left, 0.0):
                    move[move > 0] *= max(left, 0.0) / buys
            traded = abs(move).sum()
            if traded > turnover_cap:
                move *= turnover_cap / traded
            gross = abs(old + move).sum()
            if gross > gross_cap:
                kept = abs(old).sum()
                move *= max(0.0, (gross_cap - kept) / (gross - kept)) if gross > kept else 1.0
            new = old + move
            held.update(((run, s), w) for s, w in zip(day["symbol"], new, strict=True))
            yield day[["run_id", "date", "symbol"]].assign(weight=new)

    rows = weights.where("date is not null").select(F.col("run_id").cast("string"), "date", "symbol", "weight", "can_buy", "can_sell")
    if start is not None:
        none = F.lit(None)
        rows = rows.unionByName(start.select(F.col("run_id").cast("string"), none.cast("date").alias("date"), "symbol", "weight", none.cast("boolean").alias("can_buy"), none.cast("boolean").alias("can_sell")))
    # what is held before the first day has no date and comes first
    return rows.repartition("run_id").sortWithinPartitions("run_id", F.asc_nulls_first("date"), "symbol").mapInPandas(replay, schema)


def end_weights(realised: DataFrame) -> DataFrame:
    """(run_id, symbol, weight) held after each symbol's last day."""
    return realised.groupBy("run_id", "symbol").agg(F.max_by("weight", "date").alias("weight"))


def with_drawdown(daily: DataFrame, value: str, name: str = "drawdown", capital_is_peak: bool = False) -> DataFrame:
    """expm1 of the running sum below its running maximum."""
    total = F.sum(value).over(run_window().rowsBetween(Window.unboundedPreceding, 0))
    out = daily.withColumn("_c", total)
    peak = F.max("_c").over(run_window().rowsBetween(Window.unboundedPreceding, 0))
    peak = F.greatest(peak, F.lit(0.0)) if capital_is_peak else peak
    return out.withColumn(name, safe_expm1(F.col("_c") - peak)).drop("_c")


def equity_curve(daily: DataFrame, value: str) -> DataFrame:
    total = F.sum(value).over(run_window().rowsBetween(Window.unboundedPreceding, 0))
    return daily.withColumn("equity", F.exp(F.greatest(F.least(total, F.lit(60.0)), F.lit(-60.0))))


def drawdown_segment(daily: DataFrame, value: str) -> DataFrame:
    """(run_id, peak_date, trough_date, depth) of each run's deepest drawdown; the first one if they tie."""
    path = with_drawdown(daily, value).withColumn("_c", F.sum(value).over(run_window().rowsBetween(Window.unboundedPreceding, 0)))
    peak = F.max(F.struct(F.col("_c"), (-F.unix_date("date")).alias("d"))).over(run_window().rowsBetween(Window.unboundedPreceding, 0))
    path = path.withColumn("peak_date", F.date_from_unix_date(-peak["d"]))
    return path.groupBy("run_id").agg(F.min(F.struct("drawdown", "date", "peak_date")).alias("m")).select("run_id", F.col("m.peak_date"), F.col("m.date").alias("trough_date"), F.col("m.drawdown").alias("depth"))


def performance_metrics(daily: DataFrame, by: list[str] | None = None, epsilon: float = 0.0) -> DataFrame:
    """The thirteen figures of each run (or of each group `by`); missing returns count as zero.

    daily: (run_id, date, strategy_return, benchmark_return, turnover).
    """
    by = by or ["run_id"]
    zero = lambda c: F.coalesce(finite(F.col(c)), F.lit(0.0))
    days = daily.withColumns({"r": zero("strategy_return"), "b": zero("benchmark_return"), "t": zero("turnover")})
    order = Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    days = days.withColumn("_c", F.sum("r").over(order)).withColumn("_dd", safe_expm1(F.col("_c") - F.max("_c").over(order)))
    root = math.sqrt(YEAR_DAYS)

    def ratio(mean: Column, spread: Column) -> Column:
        spread = spread + epsilon
        return F.when(spread > 0, mean / F.nullif(spread, F.lit(0.0)) * root).otherwise(0.0)

    down = lambda c: F.sqrt(F.avg(F.pow(F.least(F.col(c), F.lit(0.0)), 2)))
    out = days.groupBy(*by).agg(
        F.count("*").alias("days"),
        safe_expm1(F.sum("r")).alias("cumulative_return"),
        safe_expm1(F.avg("r") * YEAR_DAYS).alias("annualized_return"),
        safe_expm1(F.avg("r") * YEAR_DAYS).alias("cagr"),
        ratio(F.avg("r"), F.stddev_pop("r")).alias("sharpe"),
        ratio(F.avg("b"), F.stddev_pop("b")).alias("sharpe_baseline"),
        ratio(F.avg("r"), down("r")).alias("sortino"),
        ratio(F.avg("b"), down("b")).alias("sortino_baseline"),
        F.min("_dd").alias("max_drawdown"),
        F.avg("t").alias("mean_turnover"),
        F.avg((F.col("r") > 0).cast("double")).alias("hit_rate"),
        safe_expm1(F.sum("b")).alias("cumulative_benchmark"),
    )
    out = out.withColumn("calmar", F.when(F.col("max_drawdown") < 0, F.col("annualized_return") / F.abs(F.nullif("max_drawdown", F.lit(0.0)))).otherwise(0.0))
    return out.withColumn("excess", F.col("cumulative_return") - F.col("cumulative_benchmark"))


def metrics_by_year(daily: DataFrame) -> DataFrame:
    dated = daily.where("date is not null").withColumn("year", F.year("date"))
    return performance_metrics(dated, ["run_id", "year"], epsilon=1e-8)


def daily_ic(panel: DataFrame, score: str) -> DataFrame:
    """Rank correlation of score and next return on each day, over tradable finite rows; 0 below two rows."""
    ok = panel.where(F.col("tradable") & finite(F.col(score)).isNotNull() & finite(F.col("return_1d")).isNotNull()).select("date", "symbol", F.col(score).alias("s"), F.col("return_1d").alias("r"))
    ranked = ok.withColumn("x", F.row_number().over(day_window().orderBy("s", "symbol")).cast("double")).withColumn("y", F.row_number().over(day_window().orderBy("r", "symbol")).cast("double"))
    return _day_correlation(ranked, panel, "ic")


def daily_corr(panel: DataFrame, score: str, name: str = "corr") -> DataFrame:
    """Pearson correlation of score and next return on each day, with the same floor."""
    ok = panel.where(F.col("tradable") & finite(F.col(score)).isNotNull() & finite(F.col("return_1d")).isNotNull())
    return _day_correlation(ok.select("date", F.col(score).alias("x"), F.col("return_1d").alias("y")), panel, name)


def _day_correlation(rows: DataFrame, panel: DataFrame, name: str) -> DataFrame:
    centred = rows.withColumn("x", F.col("x") - F.avg("x").over(day_window())).withColumn("y", F.col("y") - F.avg("y").over(day_window()))
    day = centred.groupBy("date").agg(F.sum(F.col("x") * F.col("y")).alias("xy"), F.sqrt(F.sum(F.col("x") * F.col("x")) * F.sum(F.col("y") * F.col("y"))).alias("d"), F.count("*").alias("n"))
    day = day.select("date", F.when(F.col("n") >= 2, F.col("xy") / F.greatest("d", F.lit(1e-8))).otherwise(0.0).alias(name), "n")
    return panel.select("date").distinct().join(day, "date", "left").select("date", F.coalesce(name, F.lit(0.0)).alias(name), F.coalesce("n", F.lit(0)).alias("n"))


def half_rank_ic(panel: DataFrame, score: str) -> DataFrame:
    """Raw score against ranked return on each day."""
    ok = panel.where(F.col("tradable") & finite(F.col(score)).isNotNull() & finite(F.col("return_1d")).isNotNull())
    ranked = ok.select("date", F.col(score).alias("x"), F.row_number().over(day_window().orderBy("return_1d", "symbol")).cast("double").alias("y"))
    return _day_correlation(ranked, panel, "half_rank_ic")


def ic_summary(ic: DataFrame, value: str = "ic") -> DataFrame:
    x = finite(F.col(value))
    out = ic.agg(F.count(x).alias("days"), F.coalesce(F.avg(x), F.lit(0.0)).alias("ic_mean"), F.coalesce(F.stddev_pop(x) + 1e-8, F.lit(0.0)).alias("ic_std"), F.coalesce(F.avg((x > 0).cast("double")), F.lit(0.0)).alias("ic_positive"))
    return out.withColumn("icir", F.when(F.col("ic_std") > 0, F.col("ic_mean") / F.nullif("ic_std", F.lit(0.0)) * math.sqrt(YEAR_DAYS)).otherwise(0.0))


def cross_section_zscore(panel: DataFrame, value: str, name: str) -> DataFrame:
    out = panel.withColumn("_v", clean(F.col(value)))
    out = out.withColumn("_m", F.avg("_v").over(day_window())).withColumn("_n", F.greatest(F.count("*").over(day_window()), F.lit(2)).cast("double"))
    out = out.withColumn("_s", F.sqrt(F.sum(F.pow(F.col("_v") - F.col("_m"), 2)).over(day_window()) / F.col("_n")) + 1e-6)
    return out.withColumn(name, (F.col("_v") - F.col("_m")) / F.col("_s")).drop("_v", "_m", "_n", "_s")


def fama_macbeth_slope(panel: DataFrame, score: str) -> DataFrame:
    """Slope of the demeaned return on the standardised score, for each day."""
    ok = panel.where(F.col("tradable") & F.col("return_1d").isNotNull())
    z = cross_section_zscore(ok, score, "z").withColumn("y", F.col("return_1d") - F.avg("return_1d").over(day_window()))
    return z.groupBy("date").agg((F.sum(F.col("z") * F.col("y")) / F.greatest(F.sum(F.col("z") * F.col("z")), F.lit(1e-6))).alias("slope"))


def series_tstat(series: DataFrame, value: str) -> DataFrame:
    x = F.col(value)
    return series.agg((F.avg(x) / F.sqrt(F.var_pop(x) + 1e-8) * F.sqrt(F.count(x).cast("double"))).alias("tstat"))


def block_stability(daily: DataFrame, value: str, blocks: int = 8, worst: float = 0.25) -> DataFrame:
    """-mean + std - mean of the worst blocks, over equal blocks' means, per run; 0 below two days.

    The last value pads the series to full blocks, also to blocks of padding alone.
    """
    run = daily.groupBy("run_id").agg(F.count("*").alias("n"), F.max_by(value, "date").alias("last"))
    run = run.withColumn("b", F.greatest(F.least(F.lit(max(1, blocks)), "n"), F.lit(2))).withColumn("size", F.ceil(F.col("n") / F.col("b")))
    rows = daily.select("run_id", F.col(value).alias("v"), (F.row_number().over(run_window()) - 1).alias("i")).join(run, "run_id")
    sums = rows.groupBy("run_id", F.floor(F.col("i") / F.col("size")).alias("block")).agg(F.sum("v").alias("s"), F.count("*").alias("c"))
    grid = run.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b").cast("long") - 1)).alias("block"))
    m = (F.coalesce("s", F.lit(0.0)) + (F.col("size") - F.coalesce("c", F.lit(0))) * F.col("last")) / F.col("size")
    means = grid.join(sums, ["run_id", "block"], "left").withColumn("m", m)
    means = means.withColumn("r", F.row_number().over(Window.partitionBy("run_id").orderBy("m", "block")))
    low = F.avg(F.when(F.col("r") <= F.greatest(F.bround(F.col("b") * min(max(worst, 0.0), 1.0), 0), F.lit(1)), F.col("m")))
    loss = -F.avg("m") + F.sqrt(F.var_pop("m") + 1e-8) - low
    return means.groupBy("run_id").agg(F.when(F.first("n") >= 2, loss).otherwise(0.0).alias("block_stability"))


def regime_stability(daily: DataFrame, threshold: float = 0.002) -> DataFrame:
    """-mean + std + softplus(-worst) over the mean returns in falling, flat and rising markets; 0 below two regimes."""
    regime = F.when(F.col("benchmark_return") <= -threshold, "down").when(F.col("benchmark_return") >= threshold, "up").otherwise("flat")
    means = daily.groupBy("run_id", regime.alias("regime")).agg(F.avg("strategy_return").alias("m"))
    value = -F.avg("m") + F.sqrt(F.var_pop("m") + 1e-8) + softplus(-F.min("m"))
    return means.groupBy("run_id").agg(F.when(F.count("*") >= 2, value).otherwise(0.0).alias("regime_stability"))


def excess_risk(daily: DataFrame, alpha: float = 0.95, drawdown_target: float = 0.2) -> DataFrame:
    """Mean excess, value at risk, expected shortfall, drawdown of relative equity from its own peak, and its penalty, per run."""
    x = daily.withColumn("excess", F.col("strategy_return") - F.col("benchmark_return"))
    var = x.groupBy("run_id").agg(F.percentile(-F.col("excess"), F.lit(alpha)).alias("var"))
    so_far = run_window().rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_e", F.exp(F.greatest(F.least(F.sum("excess").over(so_far), F.lit(60.0)), F.lit(-60.0))))
    x = x.withColumn("dd", F.col("_e") / F.greatest(F.max("_e").over(so_far), F.lit(1e-12)) - 1).join(var, "run_id")
    out = x.groupBy("run_id").agg(F.avg("excess").alias("mean_excess"), F.first("var").alias("value_at_risk"), F.avg(F.greatest(-F.col("excess") - F.col("var"), F.lit(0.0))).alias("tail"), F.min("dd").alias("relative_drawdown"))
    out = out.withColumn("cvar", F.col("value_at_risk") + F.col("tail") / (1 - alpha)).drop("tail")
    return out.withColumn("penalty", softplus((-F.col("relative_drawdown") - drawdown_target) * 20) / 20)


def risk_ratio(daily: DataFrame) -> DataFrame:
    r = F.col("strategy_return")
    root = math.sqrt(YEAR_DAYS)
    return daily.groupBy("run_id").agg(
        (F.avg(r) / F.sqrt(F.var_pop(r) + 1e-8) * root).alias("sharpe_ratio"), (F.avg(r) / F.sqrt(F.avg(F.pow(F.least(r, F.lit(0.0)), 2)) + 1e-8) * root).alias("sortino_ratio"), (YEAR_DAYS * F.avg(r)).alias("log_utility")
    )


def masked_mse(panel: DataFrame, prediction: str, mask: Column) -> DataFrame:
    e = F.pow(F.col(prediction) - F.col("return_1d"), 2)
    return panel.agg((F.coalesce(F.sum(F.when(mask, e)), F.lit(0.0)) / F.greatest(F.count(F.when(mask, e)), F.lit(1))).alias("mse"))


def objective_scorecard(
    daily: DataFrame, cost_weight: float = 0.1, excess_target: float = 0.0, cvar_budget: float = 0.03, drawdown_budget: float = 0.2, turnover_budget: float = 0.3, turnover_weight: float = 0.0, drawdown_weight: float = 0.0
) -> DataFrame:
    """Composite objectives of finished runs, lower is better."""
    short = F.greatest(excess_target - (F.col("strategy_return") - F.col("benchmark_return")), F.lit(0.0))
    means = daily.groupBy("run_id").agg(F.avg("turnover").alias("mean_turnover"), F.avg(short).alias("underperformance"))
    x = risk_ratio(daily).join(excess_risk(daily), "run_id").join(means, "run_id").join(regime_stability(daily), "run_id").join(block_stability(daily, "strategy_return"), "run_id")
    over = lambda v, budget: F.greatest(v - budget, F.lit(0.0))
    risk = -F.col("mean_excess") + F.col("cvar") + drawdown_weight * F.col("penalty")
    budgets = over(F.col("cvar"), cvar_budget) + over(-F.col("relative_drawdown"), drawdown_budget) + turnover_weight * over(F.col("mean_turnover"), turnover_budget)
    return x.select(
        "run_id",
        (-F.col("sharpe_ratio") + cost_weight * F.col("mean_turnover")).alias("sharpe_turnover"),
        risk.alias("excess_cvar_drawdown"),
        (risk + F.col("underperformance") + budgets).alias("outperformance"),
        (F.col("regime_stability") + F.col("block_stability")).alias("generalization"),
    )


#: Weights of the terms of the factor objective; each term is lower for a better factor.
FACTOR_TERMS = {
    "slope_tstat": 1.0, "ic_tstat": 0.5, "factor_tstat": 0.25, "block_stability": 0.2, "regime_stability": 0.2, "consistency": 0.05,
    "net_exposure": 0.05, "gross_exposure": 0.02, "concentration": 0.02, "turnover": 0.02, "score_l2": 0.001,
}


def factor_objective(book: DataFrame, augmented: str | None = None, temperature: float = 1.0, leverage: float = 1.0, buy_fee: float = 0.0, sell_fee: float = 0.0, blocks: int = 4, terms: dict[str, float] | None = None) -> DataFrame:
    """Each run's scores as a factor: (run_id, one column per term, objective), lower is better.

    book: dense (run_id, date, symbol, score, weight, return_1d, tradable).
    The scores of a day's tradable symbols are standardised; the terms are
    minus the t-statistics of the daily slope of returns on scores, of their
    correlation, and of the return of the book that holds the scores' tanh at
    gross one; that book's stability over blocks of days and over regimes;
    and the means of squared net weight, squared distance of gross weight from
    `leverage`, concentration, turnover from the second day on, and squared
    scores.  With a second column of scores, `augmented`, what their daily
    correlation with the first lacks to one is a term too.  Missing values are
    zero; days below two tradable symbols have slope and correlation zero.
    """
    terms = {**FACTOR_TERMS, **(terms or {})}
    day = Window.partitionBy("run_id", "date")
    ok = F.coalesce("tradable", F.lit(False))
    zero = F.lit(0.0)
    mine = lambda c: F.when(F.col("_ok"), c)
    n = F.greatest(F.count_if(F.col("_ok")).over(day), F.lit(1))

    def standard(x: DataFrame, value: str, name: str) -> DataFrame:
        x = x.withColumn("_c", F.greatest(F.least(F.coalesce(F.nanvl(F.col(value), F.lit(None).cast("double")), zero), F.lit(20.0)), F.lit(-20.0)))
        x = x.withColumn("_m", F.coalesce(F.sum(mine(F.col("_c"))).over(day), zero) / n)
        x = x.withColumn("_s", F.coalesce(F.sum(mine(F.pow(F.col("_c") - F.col("_m"), 2))).over(day), zero) / F.greatest(n, F.lit(2)))
        return x.withColumn(name, F.coalesce(mine((F.col("_c") - F.col("_m")) / F.sqrt(F.col("_s") + 1e-6)), zero)).drop("_c", "_m", "_s")

    x = book.withColumns({"_ok": ok, "_r": F.coalesce(finite(F.col("return_1d")), zero), "_w": F.coalesce(finite(F.col("weight")), zero)})
    x = standard(standard(x, "score", "_z"), "_z", "_zz")
    x = standard(x, augmented, "_a") if augmented else x
    x = x.withColumn("_t", F.coalesce(mine(F.tanh(F.col("_z") / max(temperature, 0.05))), zero))
    x = x.withColumn("_f", F.col("_t") / F.greatest(F.sum(F.abs("_t")).over(day), F.lit(1e-12)))
    x = x.withColumns({"_df": F.col("_f") - F.lag("_f", 1, 0.0).over(book_window()), "_dw": F.abs(F.col("_w") - F.lag("_w").over(book_window()))})
    total = lambda c: F.coalesce(F.sum(mine(c)), zero)
    count = F.count_if(F.col("_ok"))
    some = F.greatest(count, F.lit(1))

    def covariance(a: str, b: str) -> Column:
        return total(F.col(a) * F.col(b)) - total(F.col(a)) * total(F.col(b)) / some

    def correlation(a: str, b: str) -> Column:
        return F.when(count >= 2, covariance(a, b) / F.sqrt(F.greatest(covariance(a, a) * covariance(b, b), F.lit(1e-8)))).otherwise(0.0)

    daily = x.groupBy("run_id", "date").agg(
        F.when(count >= 2, covariance("_zz", "_r") / F.greatest(total(F.col("_zz") * F.col("_zz")), F.lit(1e-6))).otherwise(0.0).alias("slope"),
        correlation("_z", "_r").alias("ic"),
        (F.sum(F.col("_f") * F.col("_r")) - buy_fee * F.sum(F.greatest("_df", zero)) - sell_fee * F.sum(F.greatest(-F.col("_df"), zero))).alias("strategy_return"),
        (total(F.col("_r")) / some).alias("benchmark_return"),
        (1 - correlation("_z", "_a") if augmented else zero).alias("apart"),
        F.pow(F.sum("_w"), 2).alias("net"),
        F.pow(F.sum(F.abs("_w")) - leverage, 2).alias("gross"),
        (total(F.col("_w") * F.col("_w")) * some).alias("concentrated"),
        F.sum("_dw").alias("turned"),
        (total(F.col("_z") * F.col("_z")) / some).alias("l2"),
    )
    # one row per run and day, read by the three parts below
    daily = cut(daily)
    tstat = lambda c: -F.avg(c) / F.sqrt(F.var_pop(c) + 1e-8) * F.sqrt(F.count(c).cast("double"))
    means = {"consistency": "apart", "net_exposure": "net", "gross_exposure": "gross", "concentration": "concentrated", "turnover": "turned", "score_l2": "l2"}
    run = daily.groupBy("run_id").agg(
        *(tstat(c).alias(name) for name, c in (("slope_tstat", "slope"), ("ic_tstat", "ic"), ("factor_tstat", "strategy_return"))), *(F.coalesce(F.avg(c), zero).alias(name) for name, c in means.items())
    )
    run = run.join(block_stability(daily, "strategy_return", blocks), "run_id").join(regime_stability(daily), "run_id")
    objective = sum((terms[name] * F.col(name) for name in FACTOR_TERMS), zero)
    return run.select("run_id", *FACTOR_TERMS, objective.alias("objective"))


def portfolio_autoencoder_objective(weights: DataFrame, cost: float = 0.001425, turnover_weight: float = 0.1, concentration_weight: float = 0.01) -> DataFrame:
    """(run_id, objective): minus the yearly Sharpe ratio after costs, plus turnover and concentration; weights are dense."""
    w = F.when(F.coalesce("tradable", F.lit(False)), F.coalesce(finite(F.col("weight")), F.lit(0.0))).otherwise(0.0)
    x = weights.withColumn("_w", w).withColumn("_p", F.lag("_w", 1, 0.0).over(book_window()))
    # yesterday's weight of a symbol that can't be traded today counts as none
    x = x.withColumn("_p", F.when(F.coalesce("tradable", F.lit(False)), F.col("_p")).otherwise(0.0))
    day = x.groupBy("run_id", "date").agg(F.sum(F.col("_w") * F.coalesce(finite(F.col("return_1d")), F.lit(0.0))).alias("r"), F.sum(F.abs(F.col("_w") - F.col("_p"))).alias("t"), F.sum(F.col("_w") * F.col("_w")).alias("c"))
    net = F.col("r") - cost * F.col("t")
    sharpe = F.avg(net) / F.sqrt(F.var_pop(net) + 1e-8) * math.sqrt(YEAR_DAYS)
    return day.groupBy("run_id").agg((-sharpe + turnover_weight * F.avg("t") + concentration_weight * F.avg("c")).alias("objective"))


def portfolio_exposure(weights: DataFrame) -> DataFrame:
    """Per run and day, over tradable symbols: gross, net, long, short, largest weight, concentration, turnover and returns.

    The first day has no turnover.  `active` counts tradable symbols, and
    `untradable_abs_weight` is what lies on the others.
    """
    ok = F.coalesce("tradable", F.lit(False))
    raw = F.coalesce(F.col("weight"), F.lit(0.0))
    out = weights.withColumns({"_o": raw, "_w": F.when(ok, raw).otherwise(0.0), "_r": F.when(ok, F.coalesce("return_1d", F.lit(0.0))).otherwise(0.0)})
    out = out.withColumn("_d", F.abs(F.col("_w") - F.lag("_w").over(book_window())))
    gross = F.sum(F.abs("_w"))
    return out.groupBy("run_id", "date").agg(
        gross.alias("gross"),
        F.sum("_w").alias("net"),
        F.sum(F.greatest("_w", F.lit(0.0))).alias("long"),
        F.sum(F.greatest(-F.col("_w"), F.lit(0.0))).alias("short"),
        F.max(F.abs("_w")).alias("max_abs_weight"),
        (F.sum(F.col("_w") * F.col("_w")) / F.pow(F.greatest(gross, F.lit(1e-12)), 2)).alias("hhi"),
        F.coalesce(F.sum("_d"), F.lit(0.0)).alias("turnover"),
        F.sum(F.col("_w") * F.col("_r")).alias("strategy_return"),
        (F.sum("_r") / F.greatest(F.count_if(ok), F.lit(1))).alias("market_return"),
        F.count_if(ok).alias("active"),
        F.coalesce(F.sum(F.when(~ok, F.abs("_o"))), F.lit(0.0)).alias("untradable_abs_weight"),
    )


def portfolio_summary(weights: DataFrame) -> DataFrame:
    """One row per run of a dense book; weights count whether they can be traded or not."""
    ok = F.coalesce("tradable", F.lit(False))
    w = F.coalesce(F.col("weight"), F.lit(0.0))
    x = weights.withColumn("_w", w).withColumn("_d", F.abs(w - F.lag(w).over(book_window())))
    day = x.groupBy("run_id", "date").agg(
        F.sum(F.abs("_w")).alias("gross"), F.sum("_w").alias("net"), F.sum(F.greatest("_w", F.lit(0.0))).alias("long"), F.sum(F.greatest(-F.col("_w"), F.lit(0.0))).alias("short"), (F.sum(F.col("_w") * F.col("_w")) * F.greatest(F.count_if(ok), F.lit(1))).alias("hhi"),
        F.max(F.abs("_w")).alias("top"), F.sum(F.col("_w") * F.coalesce("return_1d", F.lit(0.0))).alias("r"), F.sum("_d").alias("t"), F.coalesce(F.sum(F.when(~ok, F.abs("_w"))), F.lit(0.0)).alias("u"), F.count("*").alias("n"),
    )
    return day.groupBy("run_id").agg(
        F.count("*").alias("rows"), F.max("n").alias("symbols"), F.avg("gross").alias("mean_gross"), F.avg(F.abs("net")).alias("mean_abs_net"), F.avg("long").alias("mean_long_gross"), F.avg("short").alias("mean_short_gross"), F.avg("hhi").alias("mean_scaled_hhi"),
        F.avg("top").alias("max_abs_weight_mean"), F.max("top").alias("max_abs_weight_max"), F.avg("r").alias("mean_daily_log_return"), F.coalesce(F.avg("t"), F.lit(0.0)).alias("mean_turnover_proxy"), F.sum("u").alias("untradable_abs_weight_sum"),
    )


def symbol_contribution(weights: DataFrame) -> DataFrame:
    """Mean weights of each symbol, its contribution on tradable days, and the mean of these."""
    ok = F.coalesce("tradable", F.lit(False))
    p = F.when(ok, F.col("weight") * F.coalesce("return_1d", F.lit(0.0))).otherwise(0.0)
    out = weights.groupBy("run_id", "symbol").agg(F.avg("weight").alias("mean_weight"), F.avg(F.abs("weight")).alias("mean_abs_weight"), F.sum(p).alias("total_contribution"), F.count_if(ok).alias("active_days"))
    return out.withColumn("contribution_per_active_day", F.col("total_contribution") / F.greatest("active_days", F.lit(1)))


def regime_analysis(exposure: DataFrame, flat: float = 0.001) -> DataFrame:
    """Rows, mean returns, turnover, gross and net weight, and hit rate of each run, by market direction and by tercile of the market's absolute move.

    exposure: (run_id, date, strategy_return, market_return, turnover, gross,
    net).  A run of fewer than three days, or whose market always moves alike,
    has one volatility regime.
    """
    move = F.abs("market_return")
    edges = exposure.groupBy("run_id").agg(F.percentile(move, F.array(F.lit(1 / 3), F.lit(2 / 3))).alias("e"), F.count(move).alias("c"), F.min(move).alias("lo"), F.max(move).alias("hi"))
    x = exposure.join(edges, "run_id")
    direction = F.when(F.col("market_return") > flat, "market_up").when(F.col("market_return") < -flat, "market_down").otherwise("market_flat")
    one = (F.col("c") < 3) | (F.col("hi") <= F.col("lo")) | move.isNull()
    tercile = F.when(one, "single_vol_bucket").when(move < F.col("e")[0], "low_abs_market_move").when(move < F.col("e")[1], "mid_abs_market_move").otherwise("high_abs_market_move")
    stats = [F.count("*").alias("rows")] + [F.avg(c).alias(f"mean_{c}") for c in ("strategy_return", "market_return", "turnover", "gross", "net")] + [F.avg((F.col("strategy_return") > 0).cast("double")).alias("hit_rate")]
    parts = [x.groupBy("run_id", F.lit(kind).alias("dimension"), value.alias("regime")).agg(*stats) for kind, value in (("market_direction", direction), ("volatility_bucket", tercile))]
    return parts[0].unionByName(parts[1])


def case_days(exposure: DataFrame) -> DataFrame:
    """(run_id, case_type, date): the best, worst, busiest and most levered day of each run, the first one if days tie; a day may be several of them."""
    first = lambda c: F.struct(c.alias("v"), "date")
    figure = lambda c: F.round(c, 9)
    picks = {"best_strategy_day": -figure("strategy_return"), "worst_strategy_day": figure("strategy_return"), "highest_turnover_day": -figure("turnover"), "highest_gross_exposure_day": -figure("gross")}
    chosen = exposure.groupBy("run_id").agg(*(F.min_by("date", first(v)).alias(name) for name, v in picks.items()))
    return chosen.select("run_id", F.explode(F.array(*(F.struct(F.lit(name).alias("case_type"), F.col(name).alias("date")) for name in picks))).alias("c")).select("run_id", "c.*")


def daily_decisions(weights: DataFrame, k: int) -> DataFrame:
    """The k largest absolute weights of each run and day, with rank and side."""
    day = Window.partitionBy("run_id", "date").orderBy(F.desc(F.abs("weight")), "symbol")
    from tidemark.functions.expressions import side

    return weights.withColumn("rank", F.row_number().over(day)).where(F.col("rank") <= k).withColumn("side", side(F.col("weight")))


def case_studies(weights: DataFrame, exposure: DataFrame, k: int = 5) -> DataFrame:
    """The largest decisions on each run's case days, under each type of the day, with the day's own figures (case_...)."""
    figures = exposure.select("run_id", "date", *(F.col(c).alias(f"case_{c}") for c in ("strategy_return", "market_return", "turnover", "gross", "net")))
    # four days per run
    days = case_days(exposure).join(figures, ["run_id", "date"])
    return daily_decisions(weights, k).join(days, ["run_id", "date"])


def masked_totals(daily: DataFrame, mask: Column, gain: float = 1.0, cost: float = 0.1) -> DataFrame:
    out = daily.where(mask).groupBy("run_id").agg(F.sum("strategy_return").alias("total_return"), F.sum("turnover").alias("total_turnover"), F.count("*").alias("valid_days"))
    return out.withColumn("loss", -gain * YEAR_DAYS * F.col("total_return") / F.col("valid_days") + cost * F.col("total_turnover") / F.col("valid_days"))


def concentration(weights: DataFrame) -> DataFrame:
    a = F.abs(F.coalesce(F.col("weight"), F.lit(0.0)))
    return weights.groupBy("run_id", "date").agg(F.coalesce(F.sum(a * a) / F.nullif(F.pow(F.sum(a), 2), F.lit(0.0)), F.lit(0.0)).alias("hhi"), F.max(a).alias("max_abs_weight"))


def annual_report_lines(yearly: DataFrame, total: DataFrame) -> DataFrame:
    """Fixed-width text rows of the yearly figures, and one of the whole run."""
    line = lambda label: F.format_string("%-6s %10.4f %10.4f %10.4f %10.4f", label, F.col("cumulative_return"), F.col("sharpe"), F.col("max_drawdown"), F.col("mean_turnover"))
    rows = yearly.select("run_id", F.col("year").cast("string").alias("label"), line(F.col("year").cast("string")).alias("line"))
    return rows.unionByName(total.select("run_id", F.lit("total").alias("label"), line(F.lit("total")).alias("line")))


def expanding_year_folds(dates: DataFrame, min_train_years: int = 1) -> DataFrame:
    """(fold_id, val_year, first_year, last_year): train on the years before, validate on one, test on all after."""
    years = dates.select(F.year("date").alias("year")).where("year is not null").distinct()
    # at most one row per calendar year
    ordered = Window.orderBy("year")
    years = years.withColumn("i", F.row_number().over(ordered)).withColumn("n", F.count("*").over(Window.partitionBy()))
    years = years.withColumn("first_year", F.min("year").over(Window.partitionBy())).withColumn("last_year", F.max("year").over(Window.partitionBy()))
    folds = years.where((F.col("i") > min_train_years) & (F.col("i") < F.col("n")))
    return folds.select((F.col("i") - min_train_years - 1).alias("fold_id"), F.col("year").alias("val_year"), "first_year", "last_year")


def assign_folds(panel: DataFrame, folds: DataFrame) -> DataFrame:
    """Rows once for each fold, with its split; folds are one row per year and broadcast."""
    split = F.when(F.year("date") < F.col("val_year"), "train").when(F.year("date") == F.col("val_year"), "val").otherwise("test")
    return panel.where("date is not null").crossJoin(F.broadcast(folds.select("fold_id", "val_year"))).withColumn("split", split)


def first_test_year(assigned: DataFrame) -> DataFrame:
    test = assigned.where("split = 'test'").withColumn("_y", F.min(F.year("date")).over(Window.partitionBy("fold_id")))
    return test.where(F.year("date") == F.col("_y")).drop("_y")


def stitch_first_years(assigned: DataFrame) -> DataFrame:
    """Each fold's first test year, joined to one series of dates for each run."""
    return first_test_year(assigned)
