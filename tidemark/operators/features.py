"""Candle features, labels and tradability of a panel of bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidemark.functions.expressions import finite, limit_price, log_return, reference_price, safe_log_ratio

def series_window() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


FEATURES = (
    "open_logret_1d", "max_logret_1d", "min_logret_1d", "close_logret_1d", "trading_volume_logret_1d", "signed_vol", "body_ratio", "signed_body_ratio",
    "delta_body_ratio", "clv", "clv_centered", "delta_clv", "upper_shadow", "lower_shadow", "shadow_imbalance",
)


def return_price(bars: DataFrame):
    """adjclose if the table has it, else close."""
    return F.col("adjclose" if "adjclose" in bars.columns else "close")


def volume_policy(bars: DataFrame, policy: str | bool = "auto", market: str = "stock") -> bool:
    """Whether volume is used; raises if it is required and missing."""
    required = market in ("stock", "crypto", "tw") if policy == "auto" else policy in (True, "required")
    if required and "Trading_Volume" not in bars.columns:
        raise ValueError(f"market {market}: Trading_Volume is required")
    return "Trading_Volume" in bars.columns


def features(bars: DataFrame) -> DataFrame:
    """`bars` with all candle features, label, alive and tradable.

    Lags are by row within a symbol.  All of it shares one sort of each
    symbol's series.
    """
    volume = finite(F.col("Trading_Volume")) if "Trading_Volume" in bars.columns else F.lit(None).cast("double")
    price = return_price(bars)
    lag = lambda c: F.lag(c).over(series_window())
    o, h, l, c = (finite(F.col(k)) for k in ("open", "max", "min", "close"))
    span = F.greatest(h - l, F.lit(0.0)) + 1e-8
    out = bars.withColumns(
        {
            "open_logret_1d": log_return(o, lag("open")),
            "max_logret_1d": log_return(h, lag("max")),
            "min_logret_1d": log_return(l, lag("min")),
            "close_logret_1d": log_return(c, lag("close")),
            "trading_volume_logret_1d": safe_log_ratio(volume, lag("Trading_Volume") if "Trading_Volume" in bars.columns else volume),
            "body_ratio": F.abs(c - o) / span,
            "signed_body_ratio": (c - o) / span,
            "clv": (c - l) / span,
            "upper_shadow": (h - F.greatest(o, c)) / span,
            "lower_shadow": (F.least(o, c) - l) / span,
            "intraday_return_co": safe_log_ratio(c, o),
            "overnight_gap_oc": safe_log_ratio(o, lag("close")),
            "intraday_range": safe_log_ratio(h, l),
            "return_1d": log_return(F.lead(price).over(series_window()), price),
            "alive": c.isNotNull(),
            "tradable": c.isNotNull() & (volume.isNull() | (volume > 0)),
        }
    )
    return out.withColumns(
        {
            "signed_vol": F.signum("intraday_return_co") * F.col("trading_volume_logret_1d"),
            "delta_body_ratio": F.col("body_ratio") - lag("body_ratio"),
            "clv_centered": F.col("clv") - 0.5,
            "delta_clv": F.col("clv") - lag("clv"),
            "shadow_imbalance": F.col("upper_shadow") - F.col("lower_shadow"),
        }
    )


def with_events(panel: DataFrame, events: DataFrame) -> DataFrame:
    """`panel` with Dividends and `Stock Splits` of its days: the day's dividends added up, its split ratios multiplied.

    events: (symbol, date, kind, value) with kind `dividend` or `split`; a day
    without events has nulls, events on days without a bar have no effect, and
    ratios that are not above zero are left out.
    """
    value = finite(F.col("value"))
    split = F.when((F.col("kind") == "split") & (value > 0), F.ln(value))
    day = events.groupBy("symbol", "date").agg(F.sum(F.when(F.col("kind") == "dividend", value)).alias("Dividends"), F.exp(F.sum(split)).alias("Stock Splits"))
    return panel.drop("Dividends", "Stock Splits").join(day, ["symbol", "date"], "left")


def limit_masks(panel: DataFrame, up: float = 1.10, down: float = 0.90) -> DataFrame:
    """`panel` with reference, can_buy and can_sell: no buying at limit-up, no selling at limit-down."""
    dividend = F.col("Dividends") if "Dividends" in panel.columns else None
    split = F.col("Stock Splits") if "Stock Splits" in panel.columns else None
    out = panel.withColumn("reference", reference_price(F.lag("close").over(series_window()), dividend, split))
    at_up = F.coalesce(F.col("close") >= limit_price(F.col("reference"), up) - 1e-9, F.lit(False))
    at_down = F.coalesce(F.col("close") <= limit_price(F.col("reference"), down) + 1e-9, F.lit(False))
    return out.withColumns({"can_buy": F.col("tradable") & ~at_up, "can_sell": F.col("tradable") & ~at_down})


def filled(panel: DataFrame, names=FEATURES) -> DataFrame:
    """Model input: missing features are zero; labels keep their nulls."""
    return panel.fillna(0.0, list(names))


def lookback(panel: DataFrame, names: list[str], length: int) -> DataFrame:
    """`panel` with `window`: the last `length` rows' features, oldest first; rows without a full window go."""
    frame = series_window().rowsBetween(-(length - 1), 0)
    out = panel.withColumn("window", F.collect_list(F.array(*(F.coalesce(F.col(n), F.lit(0.0)) for n in names))).over(frame))
    return out.where(F.size("window") == length)


def lag_columns(panel: DataFrame, names: list[str], length: int) -> DataFrame:
    """The same as one column per lag and feature, `name__k`; cheaper than arrays for short windows."""
    columns = {f"{n}__{k}": F.coalesce(F.lag(n, k).over(series_window()), F.lit(0.0)) for n in names for k in range(length)}
    return panel.withColumns(columns).withColumn("_row", F.row_number().over(series_window())).where(F.col("_row") >= length).drop("_row")
