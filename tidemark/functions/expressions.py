"""Column expressions on prices, returns and labels."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A one-day move beyond a factor of five is treated as a price error.
EXTREME = math.log(5)


def finite(x: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def floor(x: Column) -> Column:
    """The whole number at or below x, as a double: Spark's own is a long, which ends at 2^63; from 2^52 on, doubles are whole."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def round_half_up(x: Column, digits: int | Column) -> Column:
    """Half away from zero in binary arithmetic: floor(x 10^d + 0.5) / 10^d, mirrored below zero."""
    scale = F.pow(F.lit(10.0), digits if isinstance(digits, Column) else F.lit(float(digits)))
    scaled = finite(x) * scale
    return F.when(scaled >= 0, floor(scaled + 0.5) / scale).otherwise((0.0 - floor(0.5 - scaled)) / scale)


def price_decimals(symbol: Column, market: Column | None = None) -> Column:
    digits = symbol.rlike("^[0-9]+$")
    return F.when((market == "tw") | digits if market is not None else digits, 2).otherwise(8)


def safe_log_ratio(a: Column, b: Column) -> Column:
    a, b = finite(a), finite(b)
    return F.when((a > 0) & (b > 0), F.ln(a / F.nullif(b, F.lit(0.0))))


def mask_extreme(r: Column, limit: float = EXTREME) -> Column:
    return F.when(F.abs(r) <= limit, r)


def log_return(a: Column, b: Column) -> Column:
    return mask_extreme(safe_log_ratio(a, b))


# Price steps of the exchange, by upper bound of the price.
TICKS = ((10, 0.01), (50, 0.05), (100, 0.1), (500, 0.5), (1000, 1.0))
TOP_TICK = 5.0


def tick_size(price: Column) -> Column:
    out = F.when(finite(price).isNull() | (price <= 0), F.lit(None).cast("double"))
    for bound, tick in TICKS:
        out = out.when(price < bound, F.lit(tick))
    return out.otherwise(F.lit(TOP_TICK))


def limit_price(reference: Column, ratio: float) -> Column:
    raw = reference * F.lit(ratio)
    tick = tick_size(raw)
    return round_half_up(floor(raw / tick + 1e-12) * tick, 2)


def reference_price(previous: Column, dividend: Column | None = None, split: Column | None = None) -> Column:
    """The previous close after a cash dividend and a split; null if not positive."""
    value = finite(previous)
    if dividend is not None:
        value = value - F.coalesce(finite(dividend), F.lit(0.0))
    if split is not None:
        ratio = finite(split)
        value = F.when((ratio > 0) & (ratio != 1), value / F.nullif(ratio, F.lit(0.0))).otherwise(value)
    return F.when(value > 0, round_half_up(value, 2))


def safe_expm1(x: Column) -> Column:
    return F.when(x > 709.78, F.lit(float("inf"))).when(x < -745.13, F.lit(-1.0)).otherwise(F.expm1(x))


def int64_clip(x: Column, low: int = -(2**62), high: int = 2**62) -> Column:
    """Truncated to a long within bounds; null stays null."""
    return F.least(F.greatest(finite(x), F.lit(float(low))), F.lit(float(high))).cast("long")


def softplus(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def clean(x: Column, bound: float = 20.0) -> Column:
    """Missing as zero, infinities and large values at the bound."""
    return F.coalesce(F.when(F.isnan(x), F.lit(0.0)).otherwise(F.greatest(F.least(x, F.lit(bound)), F.lit(-bound))), F.lit(0.0))


def side(weight: Column) -> Column:
    return F.when(weight > 0, "long").when(weight < 0, "short").otherwise("flat")


def bar_time(x: Column) -> Column:
    """A string, date or timestamp as a timestamp without zone; null if it cannot be parsed."""
    return x.cast("string").try_cast("timestamp_ntz")


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def day_bounds_millis(day: Column) -> tuple[Column, Column]:
    start = F.unix_millis(day.cast("timestamp"))
    return start, start + 86_399_999


def previous_weekday(day: Column) -> Column:
    """`day` itself, or the Friday before it if it falls on a weekend."""
    dow = F.dayofweek(day)
    return F.date_sub(day, F.when(dow == 1, 2).when(dow == 7, 1).otherwise(0))


def is_exchange_code(symbol: Column) -> Column:
    return symbol.rlike("^[0-9]")


def is_usd_pair(symbol: Column) -> Column:
    return F.upper(symbol).endswith("USD")


# Groups of features and the marks in a feature's lower-case name, in the order of matching.
FEATURE_GROUPS = (
    ("Return", ("logret", "return", "ret_", "_ret")),
    ("Volume", ("volume", "vol", "turnover", "amount")),
    ("Candlestick", ("body", "clv", "kline", "candle")),
    ("Shadow", ("shadow", "upper", "lower")),
    ("Position", ("range", "rank", "zscore", "position", "price_level")),
)


def feature_group(feature: Column) -> Column:
    out = F.when(F.lit(False), "")
    for group, marks in FEATURE_GROUPS:
        out = out.when(F.lower(feature).rlike("|".join(marks)), group)
    return out.otherwise("Other")


def feature_label(feature: Column) -> Column:
    """Group / feature."""
    return F.concat(feature_group(feature), F.lit(" / "), feature)


def lookback_label(lag: Column) -> Column:
    return F.concat(F.lit("t-"), lag.cast("string"))
