"""Bars from streams of ticks, incremental merges and carried state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.scratch import scratch_path
from tidemark.operators.cleaning import keep_last, union_bars


def interval_bars(ticks: DataFrame, interval: str = "15 minutes", watermark: str | None = None) -> DataFrame:
    """Open, high, low, close and volume per symbol and interval; ticks: (symbol, ts, seq, price, size).

    Works on batches and streams; in a stream the watermark bounds the state.
    """
    if watermark:
        ticks = ticks.withWatermark("ts", watermark)
    order = F.struct("ts", "seq")
    out = ticks.groupBy(F.window("ts", interval), "symbol").agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("max"), F.min("price").alias("min"), F.max_by("price", order).alias("close"), F.sum("size").alias("Trading_Volume"), F.count("*").alias("ticks")
    )
    return out.select("symbol", F.col("window.start").alias("date"), "open", "max", "min", "close", "Trading_Volume", "ticks")


def drop_late_duplicates(bars: DataFrame, overlap: str = "5 days") -> DataFrame:
    """A stream's bars, each (symbol, date) once within the overlap."""
    return bars.withWatermark("date", overlap).dropDuplicatesWithinWatermark(["symbol", "date"])


def merge_stream(bars: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merge each micro-batch into bars stored by month; only the months that it touches are rewritten.

    A batch that is run again gives the same files.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("month", F.date_format("date", "yyyy-MM"))
        months = [r["month"] for r in batch.select("month").distinct().collect()]
        if not months:
            return
        try:
            old = spark.read.parquet(path).where(F.col("month").isin(months))
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            old = batch.limit(0)
        merged = keep_last(union_bars(old, batch), ["symbol", "date"])
        aside = scratch_path(spark, "merge")
        merged.write.mode("overwrite").partitionBy("month").parquet(aside)
        spark.read.parquet(aside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)

    return bars.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


STATE = T.StructType([T.StructField("segment", T.StringType()), T.StructField("symbols", T.ArrayType(T.StringType())), T.StructField("weights", T.ArrayType(T.DoubleType()))])
DAILY = "run_id string, segment string, date date, gross_return double, turnover double"


def _turnover(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """A run's daily return and turnover; the last weights are carried from batch to batch, one run's book at a time, within a segment."""
    at, held = None, {}
    if state.exists:
        at, symbols, weights = state.get
        held = dict(zip(symbols, weights, strict=True))
    rows = pd.concat(list(frames), ignore_index=True).sort_values(["date", "symbol"], kind="stable")
    out = []
    for date, day in rows.groupby("date", sort=True):
        if day["segment"].iloc[0] != at:
            # at the border of a segment what was held is gone, from the state too
            at, held = day["segment"].iloc[0], {}
        now = dict(zip(day["symbol"], day["weight"].fillna(0.0), strict=True))
        moved = sum(abs(now.get(s, 0.0) - held.get(s, 0.0)) for s in {*now, *held})
        gross = float((day["weight"].fillna(0.0) * day["return_1d"].fillna(0.0)).sum())
        out.append((key[0], at, date, gross, moved))
        held = {s: w for s, w in now.items() if w}
    state.update((at, list(held), list(held.values())))
    yield pd.DataFrame(out, columns=["run_id", "segment", "date", "gross_return", "turnover"])


def carried_turnover(weights: DataFrame) -> DataFrame:
    """The stream form of `folds.segment_turnover`: weights (run_id, segment, date, symbol, weight, return_1d) in, daily figures out.

    The state of a run is its last book and the segment that it belongs to;
    the first day of another segment starts from nothing.  Batches must arrive
    in date order.
    """
    return weights.withColumn("segment", F.col("segment").cast("string")).groupBy("run_id").applyInPandasWithState(_turnover, DAILY, STATE, "append", "NoTimeout")
