"""Linear models on lagged features, fitted for every fold from one pass over the rows.

A row's input is the features of its last `length` days, cut at the borders of
its fold's splits.  Folds train on all years before their own, so the sums that
least squares needs (counts, sums, products) are gathered once per year, in
the tasks that hold the rows; a fold adds up its years.  What reaches the
driver is one square matrix per year, whatever the number of rows, and ridge
and elastic net are solved from it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.scratch import cut
from tidemark.operators.portfolio import align_panel

COEFFICIENTS = "fold_id int, lag int, feature string, coefficient double, intercept double"


def lag_vectors(panel: DataFrame, names: list[str], length: int) -> DataFrame:
    """(date, symbol, day, tradable, return_1d, x) of every symbol on every date of the panel.

    x holds the features of the last `length` dates, oldest first; what is
    missing, also before the first date, is zero.  `day` counts the panel's
    dates from 0.
    """
    days = panel.select("date").distinct()
    days = days.withColumn("day", F.row_number().over(Window.orderBy("date")) - 1)  # one row per date
    values = F.array(*(F.coalesce(F.col(n), F.lit(0.0)) for n in names))
    dense = align_panel(panel.select("date", "symbol", "return_1d", "tradable", values.alias("_v"))).join(days, "date")
    zero = F.array(*(F.lit(0.0) for _ in names))
    own = Window.partitionBy("symbol").orderBy("date")
    dense = dense.withColumn("_v", F.coalesce("_v", zero))
    lags = [F.coalesce(F.lag("_v", k).over(own), zero) if k else F.col("_v") for k in reversed(range(length))]
    return dense.select("date", "symbol", "day", F.coalesce("tradable", F.lit(False)).alias("tradable"), "return_1d", F.flatten(F.array(*lags)).alias("x"))


def in_split(rows: DataFrame, folds: DataFrame, length: int) -> DataFrame:
    """`rows` (date, day, ...) with fold_id and split, once for each fold; rows whose window begins before the second day of their split go.

    The source asks for one day more than a full window, and so does this.
    """
    years = rows.groupBy(F.year("date").alias("_y")).agg(F.min("day").alias("first"))  # one row per year
    first = years.agg(F.min("first").alias("train_from"))
    bounds = folds.select("fold_id", "val_year").join(years.withColumnRenamed("_y", "val_year").withColumnRenamed("first", "val_from"), "val_year").crossJoin(first)
    later = bounds.select("fold_id", "val_year").join(years, F.col("_y") > F.col("val_year")).groupBy("fold_id").agg(F.min("first").alias("test_from"))
    bounds = bounds.join(later, "fold_id", "left")
    x = rows.crossJoin(F.broadcast(bounds))  # one row per fold
    year = F.year("date")
    split = F.when(year < F.col("val_year"), "train").when(year == F.col("val_year"), "val").otherwise("test")
    start = F.when(split == "train", F.col("train_from")).when(split == "val", F.col("val_from")).otherwise(F.col("test_from"))
    return x.withColumn("split", split).where(F.col("day") - start > length - 1).drop("train_from", "val_from", "test_from", "val_year")


def year_moments(rows: DataFrame) -> DataFrame:
    """(year, i, products): row i of the matrix Z'Z of each year, where Z has the columns 1, x and the label."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            year, y = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            x = batch.column(1).flatten().to_numpy().reshape(len(y), -1)
            z = np.column_stack([np.ones(len(y)), x, y])
            for k in np.unique(year):
                part = z[year == k]
                sums[k] = sums.get(k, 0.0) + part.T @ part
        for k, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), k, dtype=np.int32)), pa.array(np.arange(len(s), dtype=np.int32)), pa.array(list(s), pa.list_(pa.float64()))], names=["year", "i", "products"])

    schema = "year int, i int, products array<double>"
    usable = rows.where("tradable and return_1d is not null").select(F.year("date").alias("year"), "x", "return_1d")
    partial = usable.mapInArrow(gather, schema)
    # a row of the matrix per task and year; each group has as many rows as there are tasks
    return partial.groupBy("year", "i").applyInArrow(_summed, schema)


def _summed(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    s = table.column("products").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1).sum(axis=0)
    return pa.table({"year": table.column("year").slice(0, 1), "i": table.column("i").slice(0, 1), "products": pa.array([s], pa.list_(pa.float64()))})


def solve_ridge(centred: np.ndarray, alpha: float) -> np.ndarray:
    """b that minimises |y - Xb|^2 + alpha |b|^2; centred: products of the centred columns, the label last."""
    p = len(centred) - 1
    return np.linalg.solve(centred[:p, :p] + alpha * np.eye(p), centred[:p, p])


def solve_elastic_net(centred: np.ndarray, n: float, alpha: float, l1_ratio: float, start: np.ndarray | None = None, sweeps: int = 2000, tolerance: float = 1e-7) -> np.ndarray:
    """b that minimises |y - Xb|^2 / 2n + alpha (l1 |b|_1 + (1 - l1) |b|^2 / 2), by coordinate descent on the products."""
    p = len(centred) - 1
    gram, target = centred[:p, :p] / n, centred[:p, p] / n
    b = np.zeros(p) if start is None else start.copy()
    slope = target - gram @ b  # X'(y - Xb) / n
    one, two = alpha * l1_ratio, alpha * (1 - l1_ratio)

    def sweep(columns) -> float:
        largest = 0.0
        for j in columns:
            if gram[j, j] <= 0:
                continue
            z = slope[j] + gram[j, j] * b[j]
            new = np.sign(z) * max(abs(z) - one, 0.0) / (gram[j, j] + two)
            if new != b[j]:
                slope[:] -= gram[:, j] * (new - b[j])
                largest, b[j] = max(largest, abs(new - b[j])), new
        return largest

    for _ in range(sweeps):
        # columns in use until they settle, then all: ends when all of them stay
        for _ in range(sweeps):
            if sweep(np.flatnonzero(b)) <= tolerance * max(1e-12, np.abs(b).max()):
                break
        if sweep(range(p)) <= tolerance * max(1e-12, np.abs(b).max()):
            break
    return b


def fold_coefficients(spark: SparkSession, moments: DataFrame, folds: DataFrame, names: list[str], length: int, alpha: float = 1.0, l1_ratio: float | None = None) -> DataFrame:
    """(fold_id, lag, feature, coefficient, intercept) of each fold, from the moments of the years before its own.

    Ridge, or elastic net if `l1_ratio` is given.  Lag 0 is the day itself.  A
    fold without rows to learn from has no coefficients.
    """
    years: dict[int, np.ndarray] = {}
    p = len(names) * length
    # one matrix per year
    for r in moments.toLocalIterator():
        years.setdefault(r["year"], np.zeros((p + 2, p + 2)))[r["i"]] = r["products"]
    out, b = [], None
    for fold in folds.select("fold_id", "val_year").orderBy("fold_id").toLocalIterator():
        total = sum((m for y, m in years.items() if y < fold["val_year"]), np.zeros((p + 2, p + 2)))
        n = total[0, 0]
        if not n:
            continue
        mean = total[0, 1:] / n
        centred = total[1:, 1:] - n * np.outer(mean, mean)
        b = solve_ridge(centred, alpha) if l1_ratio is None else solve_elastic_net(centred, n, alpha, l1_ratio, b)
        level = float(mean[p] - mean[:p] @ b)
        out += [(fold["fold_id"], length - 1 - k // len(names), names[k % len(names)], float(b[k]), level) for k in range(p)]
    return spark.createDataFrame(out, COEFFICIENTS)


def _vectors(coefficients: DataFrame, names: list[str]) -> DataFrame:
    """(fold_id, b, b0): the coefficients in the order of lag_vectors, one row per fold."""
    place = F.array_position(F.array(*map(F.lit, names)), F.col("feature"))
    cell = F.struct((-F.col("lag")).alias("l"), place.alias("f"), F.col("coefficient").alias("c"))
    return coefficients.groupBy("fold_id").agg(F.transform(F.array_sort(F.collect_list(cell)), lambda s: s["c"]).alias("b"), F.first("intercept").alias("b0"))


def lag_scores(rows: DataFrame, coefficients: DataFrame, names: list[str]) -> DataFrame:
    """`rows` (fold_id, x, ...) with score, by their fold's coefficients."""
    dot = F.aggregate(F.zip_with("x", "b", lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    return rows.join(F.broadcast(_vectors(coefficients, names)), "fold_id").withColumn("score", F.col("b0") + dot).drop("b", "b0")  # one row per fold


def softmax_weights(scored: DataFrame, *by: str) -> DataFrame:
    """`scored` with weight: the softmax of the scores of the day's tradable symbols, zero for others."""
    day = Window.partitionBy(*by, "date")
    s = F.when(F.col("tradable"), F.col("score"))
    out = scored.withColumn("_e", F.exp(s - F.max(s).over(day)))
    return out.withColumn("weight", F.coalesce(F.col("_e") / F.sum("_e").over(day), F.lit(0.0))).drop("_e")


def cell_importance(scored: DataFrame, coefficients: DataFrame, names: list[str], length: int) -> DataFrame:
    """(fold_id, lag, feature, score_abs_delta, weight_abs_delta): mean changes over tradable rows if one cell is set to zero.

    A cell is a feature at a lag.  The model is linear, so the score loses the
    cell's own product; rows are not multiplied by cells.  Weights are softmax
    weights of a day, so a day's symbols meet in one group; what leaves it is
    a sum per cell, and days are added up by Spark.
    """
    lags = [length - 1 - k // len(names) for k in range(len(names) * length)]
    features = [names[k % len(names)] for k in range(len(names) * length)]

    def day(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        s = table.column("score").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy().reshape(len(s), -1)
        b = np.asarray(table.column("b")[0].as_py())
        lost = x * b

        def softmax(v: np.ndarray) -> np.ndarray:
            e = np.exp(v - v.max(axis=0))
            return e / e.sum(axis=0)

        moved = np.abs(softmax(s[:, None] - lost) - softmax(s)[:, None]).sum(axis=0)
        fold = pa.array(np.full(len(lags), table.column("fold_id")[0].as_py(), dtype=np.int32))
        return pa.table({"fold_id": fold, "lag": pa.array(lags, pa.int32()), "feature": pa.array(features, pa.string()), "score": pa.array(np.abs(lost).sum(axis=0)), "weight": pa.array(moved), "n": pa.array(np.full(len(lags), len(s), dtype=np.int64))})

    rows = scored.where("tradable").join(F.broadcast(_vectors(coefficients, names)), "fold_id").select("fold_id", "date", "score", "x", "b")  # one row per fold
    sums = rows.groupBy("fold_id", "date").applyInArrow(day, "fold_id int, lag int, feature string, score double, weight double, n long")
    return sums.groupBy("fold_id", "lag", "feature").agg((F.sum("score") / F.sum("n")).alias("score_abs_delta"), (F.sum("weight") / F.sum("n")).alias("weight_abs_delta"))


def importance_summary(cells: DataFrame) -> DataFrame:
    """(fold_id, feature, score_abs_delta, weight_abs_delta, weight_delta_share): sums over lags, and the share of the fold's total."""
    out = cells.groupBy("fold_id", "feature").agg(F.sum("score_abs_delta").alias("score_abs_delta"), F.sum("weight_abs_delta").alias("weight_abs_delta"))
    total = F.sum("weight_abs_delta").over(Window.partitionBy("fold_id"))
    share: Column = F.when(total > 0, F.col("weight_abs_delta") / F.nullif(total, F.lit(0.0))).otherwise(0.0)
    return out.withColumn("weight_delta_share", share)


def prepared(panel: DataFrame, names: list[str], length: int) -> DataFrame:
    """`lag_vectors` of the rows that can be learnt from or scored, written once for moments and scores."""
    return cut(lag_vectors(panel, names, length).where("tradable and return_1d is not null"))
