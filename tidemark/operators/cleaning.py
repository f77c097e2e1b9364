"""Cleaning, audit, repair and calendars of landed bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidemark.functions.expressions import bar_time, finite

def series_window() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")

CORE = ("date", "open", "max", "min", "close", "adjclose", "Trading_Volume")
# Vendor names of the bar columns.
VENDOR = {"Date": "date", "Datetime": "date", "index": "date", "Open": "open", "High": "max", "Low": "min", "Close": "close", "Adj Close": "adjclose", "AdjClose": "adjclose", "Volume": "Trading_Volume"}


def rename_vendor_columns(bars: DataFrame) -> DataFrame:
    return bars.withColumnsRenamed({k: v for k, v in VENDOR.items() if k in bars.columns and v not in bars.columns})


def dedupe_column_names(bars: DataFrame) -> DataFrame:
    """Repeated header names get _1, _2, ..."""
    seen: dict[str, int] = {}
    names = []
    for n in bars.columns:
        names.append(f"{n}_{seen[n]}" if n in seen else n)
        seen[n] = seen.get(n, 0) + 1
    return bars.toDF(*names)


def keep_last(rows: DataFrame, keys: list[str], order: str = "ingest_seq") -> DataFrame:
    """One row per key: the last by `order`; deterministic however the rows are spread."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def keep_first(rows: DataFrame, keys: list[str], order: str = "ingest_seq") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.asc(order))
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def union_bars(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both sets of bars by name; a column that one lacks is null there, and differing types meet as double."""
    shared = set(old.columns) & set(new.columns)
    loose = [c for c in shared if old.schema[c].dataType != new.schema[c].dataType]
    for c in loose:
        old, new = old.withColumn(c, F.col(c).try_cast("double")), new.withColumn(c, F.col(c).try_cast("double"))
    return old.unionByName(new, allowMissingColumns=True)


def canonical(bars: DataFrame, drop_empty_volume: bool = False) -> DataFrame:
    """Numbers or null, a parsed date, one row per symbol and day (the last), core columns first.

    Rows without date or close go; extra columns that are null everywhere go
    too, which one pass over the data finds.
    """
    numbers = [c for c in bars.columns if c in CORE[1:] or c in ("Dividends", "Stock Splits")]
    out = bars.withColumns({c: finite(F.col(c).try_cast("double")) for c in numbers}).withColumn("date", F.to_date(bar_time(F.col("date"))))
    out = keep_last(out.where("date is not null and close is not null"), ["symbol", "date"])
    extra = [c for c in out.columns if c not in (*CORE, "symbol", "market", "source", "ingest_seq")]
    probe = [F.count(F.col(f"`{c}`")).alias(f"x{i}") for i, c in enumerate(extra)] + [F.count_if(F.coalesce(F.col("Trading_Volume"), F.lit(0.0)) != 0).alias("volume") if "Trading_Volume" in out.columns else F.lit(1).alias("volume")]
    counts = out.agg(*probe).first()
    gone = [c for i, c in enumerate(extra) if not counts[f"x{i}"]] + (["Trading_Volume"] if drop_empty_volume and not counts["volume"] else [])
    front = [c for c in ("symbol", *CORE) if c in out.columns and c not in gone]
    return out.select(*front, *(f"`{c}`" for c in out.columns if c not in front and c not in gone))


def canonical_strict(bars: DataFrame) -> DataFrame:
    """Bars with every price present: a row with any missing one goes; missing volume is 0.

    adjclose is close where the table has no such column; within the column a
    missing value drops its row.
    """
    prices = ["open", "max", "min", "close", "adjclose"]
    out = bars if "adjclose" in bars.columns else bars.withColumn("adjclose", F.col("close"))
    volume = F.col("Trading_Volume").try_cast("double") if "Trading_Volume" in bars.columns else F.lit(None).cast("double")
    out = out.withColumns({c: finite(F.col(c).try_cast("double")) for c in prices} | {"Trading_Volume": F.coalesce(finite(volume), F.lit(0.0)).cast("long")})
    return keep_last(out.dropna(subset=["date", *prices]), ["symbol", "date"])


def audit(bars: DataFrame, as_of: Column | None = None, stale_days: int = 5, keys: list[str] | None = None, intraday: bool = False, daily_gap_days: int = 10, gap_multiple: float = 4.0) -> DataFrame:
    """Facts, issues (sorted) and status of each symbol; `bars` has raw dates as they landed.

    A symbol without a date that can be read fails; any issue is a warning.
    Duplicates are all rows of a day (a second, if intraday) with several.
    """
    keys = keys or ["symbol"]
    missing = [c for c in ("date", "open", "max", "min", "close") if c not in bars.columns]
    when = bar_time(F.col("date")) if "date" in bars.columns else F.lit(None).cast("timestamp_ntz")
    number = lambda c: F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double"))
    four = [number(c) for c in ("open", "max", "min", "close") if c in bars.columns]
    never = F.lit(False)
    null, low = never, never
    for x in four:
        null, low = null | x.isNull(), low | F.coalesce(x <= 0, never)
    bad = never
    if len(four) == 4:
        o, h, l, c = four
        bad = (h < l) | (h < o) | (h < c) | (l > o) | (l > c)
    negative = number("Trading_Volume") < 0 if "Trading_Volume" in bars.columns else never
    x = bars.withColumn("_t", when)
    day = F.date_trunc("second", "_t") if intraday else F.to_date("_t")
    days = x.groupBy(*keys, day.alias("_day")).agg(
        F.count("*").alias("n"), F.min("_t").alias("lo"), F.max("_t").alias("hi"), F.count_if(null).alias("a"), F.count_if(bad).alias("b"), F.count_if(low).alias("c"), F.count_if(negative).alias("d"),
    )
    total = lambda c, test: F.coalesce(F.sum(F.when(test, F.col(c))), F.lit(0))
    dated, every = F.col("_day").isNotNull(), F.lit(True)
    out = days.groupBy(*keys).agg(
        F.sum("n").alias("rows"), F.to_date(F.min("lo")).alias("first_date"), F.to_date(F.max("hi")).alias("last_date"), total("n", ~dated).alias("invalid_dates"), total("n", dated & (F.col("n") > 1)).alias("duplicate_dates"),
        total("a", every).alias("nan_ohlc_rows"), total("b", every).alias("bad_ohlc_rows"), total("c", every).alias("nonpositive_price_rows"), total("d", every).alias("negative_volume_rows"),
    )
    out = out.join(_gaps(x.where("_t is not null"), keys, "_t", intraday, daily_gap_days, gap_multiple), keys, "left").withColumn("gap_count", F.coalesce("gap_count", F.lit(0)))
    lag = F.datediff(as_of, F.col("last_date")) if as_of is not None else F.datediff(F.max("last_date").over(Window.partitionBy()), F.col("last_date"))
    out = out.withColumn("stale_days", lag).withColumn("missing_columns", F.lit(",".join(missing) or None).cast("string"))
    known = F.col("last_date").isNotNull()
    issue = lambda c, name: F.when(c, F.lit(name))
    found = [issue(F.lit(bool(missing)), "missing_columns"), issue(~known, "no_valid_dates" if "date" in bars.columns else "empty_or_missing_date")]
    found += [issue(known & (F.col(c) > least), name) for c, least, name in (
        ("stale_days", stale_days, "stale"), ("duplicate_dates", 0, "duplicate_dates"), ("gap_count", 0, "large_gaps"), ("nan_ohlc_rows", 0, "nan_ohlc"), ("bad_ohlc_rows", 0, "bad_ohlc"),
        ("nonpositive_price_rows", 0, "nonpositive_price"), ("negative_volume_rows", 0, "negative_volume"), ("invalid_dates", 0, "invalid_dates"),
    )]
    out = out.withColumn("issues", F.array_join(F.array_sort(F.array_compact(F.array(*found))), "|"))
    return out.withColumn("status", F.when(~known, "failed").when(F.col("issues") != "", "warn").otherwise("ok"))


def _gaps(rows: DataFrame, keys: list[str], time: str, intraday: bool, daily_gap_days: int, multiple: float) -> DataFrame:
    """(keys, max_gap_seconds, gap_count) of series of three rows or more."""
    seconds = F.unix_timestamp(F.col(time).cast("timestamp"))
    series = Window.partitionBy(*keys)
    x = rows.withColumn("_d", (seconds - F.lag(seconds).over(series.orderBy(time))).cast("double")).withColumn("_n", F.count("*").over(series)).where((F.col("_d") > 0) & (F.col("_n") >= 3)).select(*keys, "_d")
    facts = x.groupBy(*keys).agg(F.median("_d").alias("_m"), F.max("_d").alias("max_gap_seconds"))
    short = (F.col("_m") < 12 * 3600) | F.lit(intraday)
    facts = facts.withColumn("_limit", F.when(short, F.greatest(F.col("_m"), F.lit(1.0)) * max(1.0, multiple)).otherwise(F.lit(max(1, daily_gap_days) * 86400.0)))
    wide = x.join(facts.select(*keys, "_limit"), keys).groupBy(*keys).agg(F.count_if(F.col("_d") > F.col("_limit")).alias("gap_count"))
    return facts.join(wide, keys).select(*keys, "max_gap_seconds", "gap_count")


def duplicate_dates(bars: DataFrame, intraday: bool = False) -> DataFrame:
    """Rows per symbol that sit on a day (or second) with more than one row."""
    key = F.date_trunc("second", "date") if intraday else F.to_date("date")
    many = bars.groupBy("symbol", key.alias("k")).count()
    return many.groupBy("symbol").agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("duplicate_rows"))


def date_deltas(bars: DataFrame) -> DataFrame:
    """`bars` with `delta`: seconds since the symbol's previous bar."""
    seconds = F.unix_timestamp(F.col("date").cast("timestamp"))
    return bars.withColumn("delta", seconds - F.lag(seconds).over(series_window()))


def gap_summary(bars: DataFrame, intraday: bool = False) -> DataFrame:
    """Median and largest gap, and gaps above the threshold: 4 medians if intraday or short, else ten days."""
    gaps = date_deltas(bars).where("delta > 0")
    facts = gaps.groupBy("symbol").agg(F.count("*").alias("gaps"), F.median("delta").alias("median_gap"), F.max("delta").alias("max_gap")).where("gaps >= 2")
    short = (F.col("median_gap") < 12 * 3600) | F.lit(intraday)
    facts = facts.withColumn("threshold", F.when(short, 4 * F.col("median_gap")).otherwise(F.lit(10 * 86400.0)))
    wide = gaps.join(facts.select("symbol", "threshold"), "symbol").groupBy("symbol").agg(F.count_if(F.col("delta") > F.col("threshold")).alias("large_gaps"))
    return facts.join(wide, "symbol").drop("gaps")


def interval_check(bars: DataFrame, expected_seconds: float) -> DataFrame:
    """Whether each symbol's bars look like the expected interval; series without two different times pass."""
    t = F.col("date").cast("timestamp")
    midnight = (F.hour(t) == 0) & (F.minute(t) == 0) & (F.second(t) == 0)
    delta = F.when(F.col("delta") > 0, F.col("delta"))
    x = date_deltas(bars.where("date is not null"))
    out = x.groupBy("symbol").agg(F.count("*").alias("bars"), F.median(delta).alias("median_delta"), F.avg((delta >= 12 * 3600).cast("double")).alias("long_share"), F.avg(midnight.cast("double")).alias("midnight_share"))
    daily = (F.col("midnight_share") > 0.95) & (F.col("median_delta") >= 12 * 3600)
    fits = (F.col("long_share") <= 0.05) & ~daily & (F.col("median_delta") <= 4 * expected_seconds)
    return out.withColumn("passes", (F.col("bars") < 3) | F.coalesce(fits, F.lit(True)))


def status_counts(audited: DataFrame) -> DataFrame:
    return audited.groupBy("status").count()


def issue_counts(audited: DataFrame) -> DataFrame:
    return audited.where("issues != ''").select(F.explode(F.split("issues", r"\|")).alias("issue")).groupBy("issue").count()


def method_counts(repaired: DataFrame, method: str = "repair") -> DataFrame:
    """Rows by the method that repaired them."""
    return repaired.where(F.col(method).isNotNull()).groupBy(F.col(method).alias("method")).count()


def frame_checksum(panel: DataFrame, names: list[str]) -> DataFrame:
    return panel.agg(F.count("*").alias("rows"), F.sum(sum((F.coalesce(F.col(n), F.lit(0.0)) for n in names), F.lit(0.0))).alias("feature_sum"), F.sum("return_1d").alias("label_sum"), F.count_if("tradable").alias("tradable"))


def diff_frames(a: DataFrame, b: DataFrame, keys: list[str], values: list[str], rtol: float = 1e-6, atol: float = 1e-9) -> DataFrame:
    """Rows that differ: missing on one side, or a value outside the tolerance."""
    x = a.select(*keys, *(F.col(v).alias(f"{v}_a") for v in values), F.lit(True).alias("_a"))
    y = b.select(*keys, *(F.col(v).alias(f"{v}_b") for v in values), F.lit(True).alias("_b"))
    both = x.join(y, keys, "full")
    close = F.lit(True)
    for v in values:
        p, q = F.col(f"{v}_a"), F.col(f"{v}_b")
        close = close & F.coalesce(F.abs(p - q) <= atol + rtol * F.abs(q), p.eqNullSafe(q))
    return both.where(F.col("_a").isNull() | F.col("_b").isNull() | ~close).drop("_a", "_b")


def market_calendar(bars: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    days = bars.select(F.to_date("date").alias("date")).distinct()
    days = days.where(F.col("date") >= first) if first else days
    return days.where(F.col("date") <= last) if last else days


def reindex_to_calendar(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """Each symbol on every market day between its first and last bar.

    The calendar has one row per day and each symbol one range, so the range
    join yields the dense panel and nothing else.
    """
    span = bars.groupBy("symbol").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    grid = span.join(F.broadcast(calendar), (F.col("date") >= F.col("lo")) & (F.col("date") <= F.col("hi"))).select("symbol", "date")
    return grid.join(bars, ["symbol", "date"], "left")


def forward_fill(bars: DataFrame) -> DataFrame:
    """Inserted days carry the last close and adjclose; their other prices equal the close and volume is 0."""
    so_far = series_window().rowsBetween(Window.unboundedPreceding, 0)
    out = bars.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in ("close", "adjclose")})
    return out.withColumns({c: F.coalesce(F.col(c), F.col("close")) for c in ("open", "max", "min")} | {"Trading_Volume": F.coalesce("Trading_Volume", F.lit(0.0))})


def candidate_extremes(moves: DataFrame, threshold: float) -> DataFrame:
    """Investigation rows with a large move and no corporate action; all columns may be text."""
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    big = F.greatest(F.abs(number("raw_close_logret")), F.abs(number("adjclose_logret"))) >= threshold
    return moves.where(big & (number("dividends") == 0) & (number("stock_splits") == 0) & (number("capital_gains") == 0))


def event_targets(moves: DataFrame) -> DataFrame:
    """(symbol, date) of both ends of each investigated move, each once."""
    return moves.select("symbol", F.explode(F.array("raw_date", "raw_next_date")).alias("date")).where("date is not null").distinct()


# Fixed value: the reason given for symbols without a rule.
UNCLASSIFIED = "No curated repair rule yet; inspect before mutating source data."


def review_queue(targets: DataFrame, curated: DataFrame, manual: DataFrame) -> DataFrame:
    """Targets that nothing repairs by itself, with repair_method and repair_reason.

    Those of manual symbols (symbol, reason) are for manual review, and those
    of symbols that neither the curated nor the manual list knows are
    unclassified.
    """
    m = manual.select("symbol", F.col("reason").alias("repair_reason")).dropDuplicates(["symbol"])
    reviewed = targets.join(m, "symbol").withColumn("repair_method", F.lit("manual_review_no_change"))
    known = curated.select("symbol").union(m.select("symbol")).distinct()
    rest = targets.join(known, "symbol", "left_anti").withColumns({"repair_method": F.lit("unclassified_no_change"), "repair_reason": F.lit(UNCLASSIFIED)})
    return reviewed.unionByName(rest)


def neighbour_mean(value: str) -> Column:
    """Mean of the finite previous and next value in the series."""
    before, after = finite(F.lag(value).over(series_window())), finite(F.lead(value).over(series_window()))
    return F.coalesce((before + after) / 2, before, after)


PRICES = ("open", "max", "min", "close", "adjclose")


def apply_repair_rules(bars: DataFrame, rules: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """`bars` with rules applied and `repair` (the rule's method) set.

    rules: (symbol, method, factor, dates array<date>, first date, last date);
    `scale` multiplies prices by the factor, `neighbour` takes the mean of the
    adjacent rows.  A row that several rules meet takes the first by method.
    """
    rules = rules.select("symbol", "method", F.col("factor").cast("double").alias("factor"), "dates", "first", "last")
    rules = F.broadcast(rules) if rules.count() <= broadcast_rows else rules
    around = bars.withColumns({f"_{c}": neighbour_mean(c) for c in PRICES if c in bars.columns}).withColumn("_id", F.struct("symbol", "date"))
    hit = F.coalesce(F.array_contains(F.col("r.dates"), F.col("b.date")), F.lit(False)) | F.coalesce(F.col("b.date").between(F.col("r.first"), F.col("r.last")), F.lit(False))
    met = around.alias("b").join(rules.alias("r"), (F.col("b.symbol") == F.col("r.symbol")) & hit, "left").select("b.*", F.col("r.method").alias("repair"), "r.factor")
    met = met.withColumn("_r", F.row_number().over(Window.partitionBy("symbol", "date").orderBy("repair"))).where("_r = 1")
    fixed = {c: F.when(F.col("repair") == "scale", F.col(c) * F.col("factor")).when(F.col("repair") == "neighbour", F.coalesce(F.col(f"_{c}"), F.col(c))).otherwise(F.col(c)) for c in PRICES if c in bars.columns}
    return met.withColumns(fixed).select(*bars.columns, "repair")


def apply_source_repair(bars: DataFrame, source: DataFrame, atol: float = 1e-8) -> DataFrame:
    """`bars` with prices from a better source, and `changed`.

    Where all source prices are positive they replace the row's; where all are
    zero the row's prices become null.
    """
    four = PRICES[:4]
    s = source.select("symbol", "date", *(F.col(c).alias(f"s_{c}") for c in four))
    out = bars.join(s, ["symbol", "date"], "left")
    every = lambda test: F.coalesce(test("s_open") & test("s_max") & test("s_min") & test("s_close"), F.lit(False))
    good, empty = every(lambda c: F.col(c) > 0), every(lambda c: F.col(c) == 0)
    new = {c: F.when(good, F.col(f"s_{c}")).when(empty, F.lit(None).cast("double")).otherwise(F.col(c)) for c in four}
    differs = F.lit(False)
    for c in four:
        differs = differs | ~F.coalesce(F.abs(new[c] - F.col(c)) <= atol, new[c].eqNullSafe(F.col(c)))
    out = out.withColumns({f"_n_{c}": new[c] for c in four} | {"changed": differs})
    return out.withColumns({c: F.col(f"_n_{c}") for c in four}).select(*bars.columns, "changed")


def repair_ledger(before: DataFrame, after: DataFrame) -> DataFrame:
    """(symbol, date, column, old, new) of every price that a repair changed."""
    four = PRICES[:4]
    x = before.select("symbol", "date", *(F.col(c).alias(f"old_{c}") for c in four)).join(after.select("symbol", "date", *four), ["symbol", "date"])
    rows = x.select("symbol", "date", F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"old_{c}").alias("old"), F.col(c).alias("new")) for c in four))).alias("e")).select("symbol", "date", "e.*")
    return rows.where(~F.coalesce(F.abs(F.col("old") - F.col("new")) <= 1e-8, F.col("old").eqNullSafe(F.col("new"))))


def repair_plan(symbols: DataFrame, facts: DataFrame, target, required: tuple[str, ...] = CORE, stale_days: int = 0, overlap_days: int = 5, default_start: str = "2000-01-01", daily: bool = False, requested=None, retry: bool = False) -> DataFrame:
    """(symbol, plan, start_date, merge, message, first_date, last_date): what each symbol needs, and from which day.

    symbols: (symbol, delisted, unavailable, new), where `unavailable` says
    that all its tickers are on the blacklist; facts: see
    `sources.files.file_facts`.  The first rule that fits decides:
    no file; a file with an error; missing columns; delisted or unavailable
    symbols; in a `daily` update a lag of more than `stale_days`, if that is
    above 0; a last date that has reached the target; in a `daily` update a
    file already checked up to the `requested` day (the target, if none is
    given); stale.  With `retry`, unavailable symbols are tried again.
    Whole fetches begin at `default_start`; stale ones `overlap_days` before
    the last date, but not before `default_start`, and are merged.
    """
    x = symbols.join(facts.select("symbol", "columns", F.col("first_date").cast("date").alias("first_date"), F.col("last_date").cast("date").alias("last_date"), "error", F.col("checked_through").cast("date").alias("checked_through")), "symbol", "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    gone, skip = flag("delisted"), flag("unavailable") & F.lit(not retry)
    no_file = F.col("columns").isNull()
    error = F.coalesce(F.col("error"), F.when(F.col("last_date").isNull(), "no_valid_date"))
    absent = F.array_sort(F.array_except(F.array(*map(F.lit, required)), "columns"))
    lag = F.datediff(target, F.col("last_date"))
    checked = F.col("checked_through") >= (target if requested is None else requested)
    unusable = error.isin("empty", "no_valid_date")
    late = (lag > stale_days) if daily and stale_days > 0 else F.lit(False)
    plan = (
        F.when(no_file & gone, "delisted_no_history").when(no_file & skip, "not_found_skip").when(no_file & flag("new"), "new_symbol").when(no_file, "missing")
        .when(error.isNotNull() & gone, F.when(unusable, "delisted_removed").otherwise("delisted_skip")).when(error.isNotNull(), "broken")
        .when(gone, "delisted_skip").when(skip, "not_found_skip").when(F.size(absent) > 0, "schema_mismatch")
        .when(late, "lagging_skip").when(lag <= 0, "current").when(checked & F.lit(daily), "current").otherwise("stale")
    )
    message = (
        F.when(F.col("plan") == "broken", error).when(F.col("plan") == "schema_mismatch", F.concat(F.lit("missing_required_columns="), F.array_join(absent, ",")))
        .when(F.col("plan") == "lagging_skip", F.concat(F.lit("lag_days="), lag)).when((F.col("plan") == "current") & (lag > 0), F.concat(F.lit("checked_through="), F.col("checked_through")))
    )
    start = F.to_date(F.lit(default_start))
    first = F.when(F.col("plan").isin("new_symbol", "missing", "broken", "schema_mismatch"), start).when(F.col("plan") == "stale", F.greatest(start, F.date_sub("last_date", max(1, overlap_days))))
    out = x.withColumn("plan", plan)
    return out.select("symbol", "plan", first.alias("start_date"), (F.col("plan") == "stale").alias("merge"), message.alias("message"), "first_date", "last_date")


# Texts of a failed fetch that say that a symbol is not to be had.
UNAVAILABLE = ("possibly delisted; no timezone found", "possibly delisted", "no price data found", "no data found, symbol may be delisted", "quote not found", "unavailable or delisted")


def final_status(plan: Column, fetched: Column, message: Column) -> Column:
    """What a repair came to; fetched: `updated`, `empty`, `failed` or another state, which stays.

    Only a failed fetch can be `not_found`, by its message.
    """
    said = F.coalesce(F.lower(message), F.lit(""))
    unavailable = F.lit(False)
    for text in UNAVAILABLE:
        unavailable = unavailable | F.contains(said, F.lit(text))
    repaired = F.when(plan == "new_symbol", "new_symbol_repaired").when(plan == "schema_mismatch", "schema_repaired").otherwise("repaired")
    return F.when(fetched == "updated", repaired).when((fetched == "failed") & unavailable, "not_found").when(fetched == "empty", "still_stale").otherwise(fetched)


def high_water_mark(bars: DataFrame, default_start: str, step_days: int = 1) -> DataFrame:
    last = bars.groupBy("symbol").agg(F.to_date(F.max("date")).alias("last_date"))
    return last.withColumn("next_start", F.greatest(F.to_date(F.lit(default_start)), F.date_add("last_date", step_days)))


def incremental_merge(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged bars, per symbol: added rows and status); later rows win."""
    merged = keep_last(union_bars(old, new), ["symbol", "date"])
    had = old.select("symbol", "date").distinct().groupBy("symbol").agg(F.count("*").alias("before"))
    now = merged.groupBy("symbol").agg(F.count("*").alias("after")).join(had, "symbol", "left")
    added = F.col("after") - F.coalesce("before", F.lit(0))
    return merged, now.select("symbol", added.alias("added"), F.when(added > 0, "updated").otherwise("up_to_date").alias("status"))


REPAIRED = ("repaired", "schema_repaired", "new_symbol_repaired")


def coverage(audited: DataFrame, as_of: Column, repaired: DataFrame | None = None) -> DataFrame:
    """One row: oldest first date, newest last date, its lag behind `as_of` and the number of symbols with a last date.

    repaired: (symbol, status, last_date), one row per symbol; a repaired
    symbol's last date takes the place of the audited one, and symbols without
    a first date or of status `broken` are then left out.  Without any first
    or last date all figures are null and `tracked` is 0.
    """
    last = F.col("last_date")
    if repaired is not None:
        fixed = repaired.where(F.col("status").isin(*REPAIRED)).select("symbol", F.col("last_date").alias("_fixed"))
        audited = audited.where("first_date is not null and not (status <=> 'broken')").join(fixed, "symbol", "left")
        last = F.coalesce("_fixed", "last_date")
    out = audited.agg(F.min("first_date").alias("oldest"), F.max(last).alias("newest"), F.count(last).alias("tracked"))
    known = F.col("oldest").isNotNull() & F.col("newest").isNotNull()
    out = out.select(*(F.when(known, F.col(c)).alias(c) for c in ("oldest", "newest")), F.when(known, F.col("tracked")).otherwise(F.lit(0)).alias("tracked"))
    return out.withColumn("lag_days", F.datediff(as_of, F.col("newest")))


def january_years(bars: DataFrame) -> DataFrame:
    out = bars.groupBy("symbol").agg(F.count_distinct(F.when(F.month("date") == 1, F.year("date"))).alias("january_years"))
    return out.withColumn("status", F.when(F.col("january_years") > 0, "historical_found").otherwise("no_history"))


def tradable_counts(panel: DataFrame, first: str, last: str, n: int) -> DataFrame:
    part = panel.where(F.col("date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))) & F.col("tradable"))
    return part.groupBy("symbol").agg(F.count("*").alias("tradable_days")).orderBy(F.desc("tradable_days"), "symbol").limit(n)
