"""Walk-forward evaluation: windows within a split, segments, warm-up rows and reports per fold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.expressions import finite
from tidemark.functions.scratch import cut
from tidemark.operators import attribution as A
from tidemark.operators import portfolio as B


def window_dates(assigned: DataFrame, length: int) -> DataFrame:
    """(fold_id, split, date) of the dates that have a full window of `length` dates within their split and a tradable finite label.

    assigned: (fold_id, split, date, symbol, tradable, return_1d).
    """
    ok = F.coalesce(F.col("tradable"), F.lit(False)) & finite(F.col("return_1d")).isNotNull()
    days = assigned.groupBy("fold_id", "split", "date").agg(F.max(ok).alias("ok"))
    place = F.row_number().over(Window.partitionBy("fold_id", "split").orderBy("date"))
    return days.withColumn("_i", place).where((F.col("_i") >= length) & F.col("ok")).select("fold_id", "split", "date")


def segments(rows: DataFrame, by: str, order: str = "date") -> DataFrame:
    """(segment, `by`, first, last, rows) of each unbroken run of one value of `by`: where carried state starts anew.

    rows: one per `order` value, as a stitched series has them.
    """
    series = Window.orderBy(order)  # one row per day
    x = rows.withColumn("_new", F.coalesce((F.col(by) != F.lag(by).over(series)).cast("long"), F.lit(0).cast("long")))
    x = x.withColumn("segment", F.sum("_new").over(series.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy("segment", by).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("rows"))


def segment_turnover(weights: DataFrame) -> DataFrame:
    """Daily return and turnover of dense weights (run_id, segment, date, symbol, weight, return_1d) whose state starts anew in each segment."""
    w = F.coalesce(F.col("weight"), F.lit(0.0))
    before = F.lag(w, 1, 0.0).over(Window.partitionBy("run_id", "segment", "symbol").orderBy("date"))
    x = weights.withColumn("_w", w).withColumn("_d", F.abs(w - before))
    return x.groupBy("run_id", "segment", "date").agg(F.sum(F.col("_w") * F.coalesce("return_1d", F.lit(0.0))).alias("gross_return"), F.sum("_d").alias("turnover"))


def warmup_union(scores: DataFrame) -> DataFrame:
    """Each fold's test scores, and before them the previous fold's scores of dates that the fold's own windows don't reach.

    scores: (fold_id, date, first_date, symbol, score, ...); first_date is the
    first date of the fold's test split.  Rows taken over carry the fold's id
    and `warmup`.
    """
    own = scores.groupBy("fold_id").agg(F.min("date").alias("_first"), F.min("first_date").alias("_split"))
    before = scores.withColumn("fold_id", F.col("fold_id") + 1).join(F.broadcast(own), "fold_id")  # one row per fold
    before = before.where((F.col("date") < F.col("_first")) & (F.col("date") >= F.col("_split"))).withColumn("first_date", F.col("_split")).drop("_first", "_split")
    return before.withColumn("warmup", F.lit(True)).unionByName(scores.withColumn("warmup", F.lit(False)))


def first_year_report(assigned: DataFrame, concentration: DataFrame) -> DataFrame:
    """Figures of each run in each fold's first test year, with mean concentration and mean largest weight.

    concentration: (run_id, date, hhi, max_abs_weight).
    """
    first = B.first_test_year(assigned).withColumn("year", F.year("date"))
    keys = ["run_id", "fold_id", "year"]
    sums = first.join(concentration, ["run_id", "date"]).groupBy(*keys).agg(
        F.sum("strategy_return").alias("log_return"), F.sum("benchmark_return").alias("log_baseline"), F.avg("hhi").alias("mean_hhi"), F.avg("max_abs_weight").alias("mean_max_weight")
    )
    return B.performance_metrics(first, keys, epsilon=1e-8).join(sums, keys)


def fold_scores(panel: DataFrame, folds: DataFrame, names: list[str], fit: Callable = A.ridge) -> DataFrame:
    """(fold_id, split, date, symbol, score, return_1d): each fold's model, fitted on its training years, on the years after.

    A fold is a calendar year, so the loop is over a few fits and each fit is
    a Spark job over the fold's training rows.
    """
    out = None
    for fold in folds.select("fold_id", "val_year").orderBy("fold_id").toLocalIterator():
        model = fit(A.training_matrix(panel.where(F.year("date") < fold["val_year"]), names))
        scored = A.score_panel(model, A.training_matrix(panel.where(F.year("date") >= fold["val_year"]), names))
        split = F.when(F.year("date") == fold["val_year"], "val").otherwise("test")
        part = scored.select(F.lit(fold["fold_id"]).alias("fold_id"), split.alias("split"), "date", "symbol", "score", "return_1d")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no fold")
    return out


def fold_report(scores: DataFrame, k: int = 5, buy_fee: float = 0.0, sell_fee: float = 0.0) -> DataFrame:
    """Per fold and split: days, figures of the k best scores at equal weight, and the mean rank correlation of scores and labels.

    scores: (fold_id, split, date, symbol, score, return_1d), tradable rows only.
    """
    run = F.concat_ws("/", "fold_id", "split")
    x = cut(scores.withColumn("run_id", run))
    day = Window.partitionBy("run_id", "date")
    ranked = x.withColumns({"_p": F.row_number().over(day.orderBy(F.desc("score"), F.desc("symbol"))), "_n": F.count("*").over(day), "_x": F.row_number().over(day.orderBy("score", "symbol")), "_y": F.row_number().over(day.orderBy("return_1d", "symbol"))})
    ranked = cut(ranked.withColumn("weight", F.when(F.col("_p") <= k, F.lit(1.0) / F.least(F.col("_n"), F.lit(k))).otherwise(0.0)))
    grid = x.select("run_id", "date").distinct().join(x.select("run_id", "symbol").distinct(), "run_id")
    dense = grid.join(ranked.select("run_id", "date", "symbol", "weight", "return_1d"), ["run_id", "date", "symbol"], "left")
    bench = x.groupBy("run_id", "date").agg(F.avg("return_1d").alias("benchmark_return"))
    figures = B.performance_metrics(B.portfolio_daily(dense, buy_fee, sell_fee).join(bench, ["run_id", "date"]))
    # ranks are 1 to n on both sides, so their correlation needs sums of squares of differences alone
    n = F.col("n").cast("double")
    ic = ranked.groupBy("run_id", "date").agg(F.count("*").alias("n"), F.sum(F.pow(F.col("_x") - F.col("_y"), 2)).alias("d")).select("run_id", F.when(n >= 2, 1 - 6 * F.col("d") / (n * (n * n - 1))).otherwise(0.0).alias("ic"))
    ic = ic.groupBy("run_id").agg(F.avg("ic").alias("ic_mean"), F.avg((F.col("ic") > 0).cast("double")).alias("ic_positive"))
    parts = F.split("run_id", "/")
    out = figures.join(ic, "run_id").withColumns({"fold_id": parts[0].cast("int"), "split": parts[1]})
    return out.select("fold_id", "split", *(c for c in out.columns if c not in ("fold_id", "split", "run_id")))
