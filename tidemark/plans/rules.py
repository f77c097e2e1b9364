"""Registered queries of factor objectives, event-adjusted limits, snapshots, repair plans and carried state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import expressions as X
from tidemark.functions.scratch import cut, scratch_path
from tidemark.operators import attribution as A
from tidemark.operators import cleaning as C
from tidemark.operators import features as P
from tidemark.operators import folds as W
from tidemark.operators import portfolio as B
from tidemark.plans import sqlparts as S
from tidemark.plans.adapters import bars, table
from tidemark.plans.queries import _BLOCKS, _SOFT, RAW, book, panel, query
from tidemark.sources import files
from tidemark.streaming import bars as ST

# ---- objectives ------------------------------------------------------------------

def _standard_sql(value: str, name: str, source: str, target: str) -> str:
    """`source` with the standard score of a column over the day's tradable symbols."""
    return f""", {target}_m AS (SELECT *, coalesce(sum({value}) FILTER (tradable) OVER d, 0) / n AS m_ FROM {source} WINDOW d AS (PARTITION BY run_id, date)),
  {target} AS (SELECT * EXCLUDE (m_), CASE WHEN tradable THEN ({value} - m_) / sqrt(coalesce(sum(pow({value} - m_, 2)) FILTER (tradable) OVER d, 0) / greatest(n, 2) + 1e-6) ELSE 0 END AS {name} FROM {target}_m WINDOW d AS (PARTITION BY run_id, date))"""


def _cov(a: str, b: str) -> str:
    return f"(coalesce(sum({a} * {b}) FILTER (tradable), 0) - coalesce(sum({a}) FILTER (tradable), 0) * coalesce(sum({b}) FILTER (tradable), 0) / any_value(n))"


_TSTAT = "-avg({0}) / sqrt(var_pop({0}) + 1e-8) * sqrt(count({0}))"
_CORR = "CASE WHEN count(*) FILTER (tradable) >= 2 THEN {0} / sqrt(greatest({1} * {2}, 1e-8)) ELSE 0 END"


def _corr(a: str, b: str) -> str:
    return _CORR.format(_cov(a, b), _cov(a, a), _cov(b, b))


_FACTOR = (
    S.with_(*S.PANEL, S.BOOK)
    + """, aug AS (SELECT b.*, f.shadow_imbalance AS other FROM book b LEFT JOIN feats f USING (date, symbol)),
  f0 AS (SELECT run_id, date, symbol, tradable, weight AS w, coalesce(return_1d, 0) AS r, greatest(least(coalesce(score, 0), 20), -20) AS c, greatest(least(coalesce(other, 0), 20), -20) AS o, greatest(count(*) FILTER (tradable) OVER (PARTITION BY run_id, date), 1) AS n FROM aug)"""
    + _standard_sql("c", "z", "f0", "f1") + _standard_sql("z", "zz", "f1", "f2") + _standard_sql("o", "a", "f2", "f3")
    + """, f4 AS (SELECT *, CASE WHEN tradable THEN tanh(z) ELSE 0 END / greatest(sum(abs(CASE WHEN tradable THEN tanh(z) ELSE 0 END)) OVER (PARTITION BY run_id, date), 1e-12) AS f FROM f3),
  f5 AS (SELECT *, f - lag(f, 1, 0.0) OVER s AS df, abs(w - lag(w) OVER s) AS dw FROM f4 WINDOW s AS (PARTITION BY run_id, symbol ORDER BY date)),"""
    + f""" daily AS MATERIALIZED (SELECT run_id, date, CASE WHEN count(*) FILTER (tradable) >= 2 THEN {_cov('zz', 'r')} / greatest(coalesce(sum(zz * zz) FILTER (tradable), 0), 1e-6) ELSE 0 END AS slope, {_corr('z', 'r')} AS ic,
    sum(f * r) - 0.001 * sum(greatest(df, 0)) - 0.003 * sum(greatest(-df, 0)) AS strategy_return, coalesce(sum(r) FILTER (tradable), 0) / any_value(n) AS benchmark_return, 1 - {_corr('z', 'a')} AS apart,
    pow(sum(w), 2) AS net, pow(sum(abs(w)) - 1, 2) AS gross, coalesce(sum(w * w) FILTER (tradable), 0) * any_value(n) AS concentrated, sum(dw) AS turned, coalesce(sum(z * z) FILTER (tradable), 0) / any_value(n) AS l2 FROM f5 GROUP BY run_id, date),
  runs_f AS (SELECT run_id, {_TSTAT.format('slope')} AS slope_tstat, {_TSTAT.format('ic')} AS ic_tstat, {_TSTAT.format('strategy_return')} AS factor_tstat, avg(apart) AS consistency, avg(net) AS net_exposure, avg(gross) AS gross_exposure, avg(concentrated) AS concentration, avg(turned) AS turnover, avg(l2) AS score_l2 FROM daily GROUP BY run_id),
  regime_means AS (SELECT run_id, CASE WHEN benchmark_return <= -0.002 THEN 'down' WHEN benchmark_return >= 0.002 THEN 'up' ELSE 'flat' END AS g, avg(strategy_return) AS m FROM daily GROUP BY ALL),
  regimes AS (SELECT run_id, CASE WHEN count(*) >= 2 THEN -avg(m) + sqrt(var_pop(m) + 1e-8) + {_SOFT('(-min(m))')} ELSE 0 END AS regime_stability FROM regime_means GROUP BY run_id)"""
    + _BLOCKS.replace("least(8, count(*))", "least(4, count(*))")
)


@query(
    _FACTOR + f"--result SELECT run_id, {', '.join(B.FACTOR_TERMS)}, {' + '.join(f'{w} * {t}' for t, w in B.FACTOR_TERMS.items())} AS objective FROM runs_f JOIN blocks USING (run_id) JOIN regimes USING (run_id)",
    " ".join(B.FACTOR_TERMS) + " objective",
)
def q_factor_objective(spark, d):
    """Every term of the factor objective for three momentum books, with shadow imbalance as the second score."""
    other = panel(spark, d).select("date", "symbol", F.col("shadow_imbalance").alias("other"))
    return B.factor_objective(book(spark, d).join(other, ["date", "symbol"], "left"), "other", buy_fee=0.001, sell_fee=0.003)


# ---- limits with events ------------------------------------------------------------


def events(spark, d):
    """Dividends and splits of a nation's series: its customers' urgent orders, and orders of some numbers."""
    k = F.col("o_orderkey")
    x = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    x = x.select(F.concat(F.lit("N"), "c_nationkey").alias("symbol"), F.to_date("o_orderdate").alias("date"), k.alias("k"), "o_orderpriority", F.col("o_totalprice").cast("double").alias("price"))
    dividends = x.where("o_orderpriority = '1-URGENT'").select("symbol", "date", F.lit("dividend").alias("kind"), F.round(F.col("price") / 1e5, 2).alias("value"))
    ratio = F.when(F.col("k") % 50 == 0, 2.0).when(F.col("k") % 50 == 1, 0.5).when(F.col("k") % 50 == 2, 0.0).when(F.col("k") % 50 == 3, 1.0)
    return dividends.unionByName(x.where("k % 50 < 4").select("symbol", "date", F.lit("split").alias("kind"), ratio.alias("value")))


@query(
    S.with_(*S.PANEL)
    + f""", ev AS (SELECT 'N' || c_nationkey AS symbol, o_orderdate::DATE AS date, o_orderkey % 50 AS k, o_orderpriority = '1-URGENT' AS urgent, round(o_totalprice::DOUBLE / 1e5, 2) AS v FROM orders JOIN customer ON c_custkey = o_custkey),
    days AS (SELECT symbol, date, sum(v) FILTER (urgent) AS dividend, exp(sum(CASE k WHEN 0 THEN ln(2.0) WHEN 1 THEN ln(0.5) WHEN 3 THEN 0.0 END)) AS split FROM ev GROUP BY ALL),
    adjusted AS (SELECT f.*, dividend, split, lc - coalesce(dividend, 0) AS less FROM feats f LEFT JOIN days USING (symbol, date)),
    refs AS (SELECT *, CASE WHEN split > 0 AND split != 1 THEN less / split ELSE less END AS raw FROM adjusted),
    masks AS (SELECT *, CASE WHEN raw > 0 THEN {S.half_up("raw", 2)} END AS reference FROM refs)
    --result SELECT symbol, date, dividend, split, reference, tradable AND NOT coalesce(close >= {S.limit("reference", "1.1")} - 1e-9, false) AS can_buy, tradable AND NOT coalesce(close <= {S.limit("reference", "0.9")} + 1e-9, false) AS can_sell FROM masks""",
    "dividend split reference",
)
def q_limit_masks_events(spark, d):
    """Limits around references that dividends and splits have moved."""
    x = P.limit_masks(P.with_events(panel(spark, d), events(spark, d)))
    return x.select("symbol", "date", F.col("Dividends").alias("dividend"), F.col("Stock Splits").alias("split"), "reference", "can_buy", "can_sell")


# ---- snapshots ---------------------------------------------------------------------


@query(
    S.with_(S.BARS_SQL) + """, n AS (SELECT count(*) AS rows, count(*) FILTER (year(date) >= 2001) AS late FROM bars)
    --result SELECT unnest(['first', 'again', 'other options', 'changed', 'changed again']) AS step, unnest([false, true, false, false, true]) AS reused, unnest([rows, rows, rows, rows + late, rows + late]) AS rows FROM n"""
)
def q_panel_snapshot(spark, d):
    """A panel saved, reused, built anew for other options, and built anew once more when a file has come."""
    root, saved = scratch_path(spark, "landed"), scratch_path(spark, "saved")
    x = bars(spark, d)
    x.write.parquet(root)
    out = None
    for step, options in (("first", "a"), ("again", "a"), ("other options", "b"), ("changed", "b"), ("changed again", "b")):
        if step == "changed":
            x.where("year(date) >= 2001").write.mode("append").parquet(root)
        rows, reused = files.panel_snapshot(spark, root, saved, options, lambda: spark.read.parquet(root))
        part = spark.createDataFrame([(step, reused, rows.count())], "step string, reused boolean, rows long")
        out = part if out is None else out.unionByName(part)
    return out


# ---- repair plans from files ---------------------------------------------------------

#: What becomes of the files of symbol N<k>, by k modulo 8.
KINDS = {0: "full", 1: "to 2000", 2: "to 1997", 3: "no adjclose", 4: "text", 5: "no dates", 6: "checked", 7: "no date column"}


def landed_symbols(spark, d) -> str:
    """A folder per symbol in all states of repair; returns the root."""
    root = scratch_path(spark, "symbols")
    x = cut(bars(spark, d).withColumn("k", F.substring("symbol", 2, 2).cast("int")).withColumn("file", F.concat("symbol", F.lit("_features.parquet"))))
    part = lambda r: x.where(f"k % 8 = {r}").drop("k", "symbol")
    save = lambda df: df.write.mode("append").partitionBy("file").parquet(root)
    save(part(0))
    save(part(1).where("date < '2001-01-01'"))
    save(part(2).where("date < '1998-01-01'"))
    save(part(3).drop("adjclose", "max"))
    x.where("k % 8 = 4").select("file", F.concat("symbol", F.lit(" is no table")).alias("value")).write.mode("append").partitionBy("file").text(root)
    save(part(5).withColumn("date", F.lit("some day")))
    save(part(6).where("date < '2001-05-20'").withMetadata("date", {"checked_through": "2001-06-03"}))
    save(part(7).drop("date"))
    return root


@query(
    S.with_(S.BARS_SQL)
    + """, k AS (SELECT *, substr(symbol, 2)::INT AS k FROM bars), local AS (
      SELECT symbol, any_value(k) AS k, min(date) FILTER (k % 8 IN (0, 3) OR k % 8 = 1 AND date < '2001-01-01' OR k % 8 = 2 AND date < '1998-01-01' OR k % 8 = 6 AND date < '2001-05-20') AS first_date,
        max(date) FILTER (k % 8 IN (0, 3) OR k % 8 = 1 AND date < '2001-01-01' OR k % 8 = 2 AND date < '1998-01-01' OR k % 8 = 6 AND date < '2001-05-20') AS last_date FROM k GROUP BY symbol
    ), every AS (SELECT symbol, k, first_date, last_date, true AS have FROM local UNION ALL SELECT 'X' || n_nationkey, n_nationkey, NULL, NULL, false FROM nation),
    known AS (SELECT *, k IN (8, 12, 13, 15) AS gone, k IN (17, 19, 20) AS out_of_reach, k % 3 = 0 AS fresh, datediff('day', last_date, DATE '2001-06-01') AS lag FROM every),
    planned AS (SELECT *, CASE WHEN NOT have THEN CASE WHEN gone THEN 'delisted_no_history' WHEN out_of_reach THEN 'not_found_skip' WHEN fresh THEN 'new_symbol' ELSE 'missing' END
      WHEN k % 8 = 4 THEN CASE WHEN gone THEN 'delisted_skip' ELSE 'broken' END WHEN k % 8 IN (5, 7) THEN CASE WHEN gone THEN 'delisted_removed' ELSE 'broken' END
      WHEN gone THEN 'delisted_skip' WHEN out_of_reach THEN 'not_found_skip' WHEN k % 8 = 3 THEN 'schema_mismatch' WHEN lag > 400 THEN 'lagging_skip' WHEN lag <= 0 OR k % 8 = 6 THEN 'current' ELSE 'stale' END AS plan FROM known)
    --result SELECT symbol, plan, CASE WHEN plan IN ('new_symbol', 'missing', 'broken', 'schema_mismatch') THEN DATE '2000-12-20' WHEN plan = 'stale' THEN greatest(DATE '2000-12-20', last_date - 10) END::DATE AS start_date, plan = 'stale' AS merge,
      CASE WHEN plan = 'broken' THEN CASE k % 8 WHEN 4 THEN 'schema_error' WHEN 5 THEN 'no_valid_date' ELSE 'empty' END WHEN plan = 'schema_mismatch' THEN 'missing_required_columns=adjclose,max' WHEN plan = 'lagging_skip' THEN 'lag_days=' || lag WHEN plan = 'current' AND lag > 0 THEN 'checked_through=2001-06-03' END AS message,
      first_date, last_date FROM planned"""
)
def q_repair_plan(spark, d):
    """A daily update's plan from what is on disk, in all its states."""
    facts = files.file_facts(spark, landed_symbols(spark, d))
    local, listed = bars(spark, d).select("symbol").distinct(), table(spark, d, "nation").select(F.concat(F.lit("X"), "n_nationkey").alias("symbol"))
    k = F.substring("symbol", 2, 2).cast("int")
    symbols = local.unionAll(listed).select("symbol", k.isin(8, 12, 13, 15).alias("delisted"), k.isin(17, 19, 20).alias("unavailable"), (k % 3 == 0).alias("new"))
    out = C.repair_plan(symbols, facts, F.to_date(F.lit("2001-06-01")), stale_days=400, overlap_days=10, default_start="2000-12-20", daily=True)
    # the reason is the reader's own
    return out.withColumn("message", F.regexp_replace("message", "^(schema_error): .*$", "$1"))


@query(
    S.with_(S.BARS_SQL)
    + """, k AS (SELECT *, substr(symbol, 2)::INT AS k FROM bars)
    --result SELECT symbol, min(date) FILTER (k % 8 IN (0, 3) OR k % 8 = 1 AND date < '2001-01-01' OR k % 8 = 2 AND date < '1998-01-01' OR k % 8 = 6 AND date < '2001-05-20') AS first_date,
      max(date) FILTER (k % 8 IN (0, 3) OR k % 8 = 1 AND date < '2001-01-01' OR k % 8 = 2 AND date < '1998-01-01' OR k % 8 = 6 AND date < '2001-05-20') AS last_date,
      CASE any_value(k) % 8 WHEN 4 THEN 'schema_error' WHEN 5 THEN 'no_valid_date' WHEN 7 THEN 'empty' END AS error, CASE WHEN any_value(k) % 8 = 6 THEN '2001-06-03' END AS checked_through,
      CASE any_value(k) % 8 WHEN 4 THEN '' WHEN 3 THEN 'Trading_Volume,close,date,min,open' WHEN 7 THEN 'Trading_Volume,adjclose,close,max,min,open' ELSE 'Trading_Volume,adjclose,close,date,max,min,open' END AS columns FROM k GROUP BY symbol"""
)
def q_file_facts(spark, d):
    """Columns, dates, faults and footers of every symbol's files."""
    out = files.file_facts(spark, landed_symbols(spark, d))
    return out.withColumns({"error": F.regexp_replace("error", "^(schema_error): .*$", "$1"), "columns": F.array_join("columns", ",")})


# ---- carried state -------------------------------------------------------------------


@query(
    S.with_(*S.PANEL, S.BOOK)
    + """, s AS (SELECT *, coalesce(weight, 0) AS w, year(date) AS segment FROM book), m AS (SELECT *, abs(w - lag(w, 1, 0.0) OVER (PARTITION BY run_id, segment, symbol ORDER BY date)) AS moved FROM s)
    --result SELECT run_id, segment::VARCHAR AS segment, date, sum(w * coalesce(return_1d, 0)) AS gross_return, sum(moved) AS turnover FROM m GROUP BY run_id, segment, date""",
    "gross_return turnover",
)
def q_stream_turnover(spark, d):
    """Daily turnover of three books by a stream whose batches end in the middle of years, while books start anew with each year."""
    root = scratch_path(spark, "weights")
    x = cut(book(spark, d).select("run_id", F.year("date").alias("segment"), "date", "symbol", "weight", "return_1d"))
    bounds = ["1900-01-01", "1996-06-15", "1998-03-01", "1998-09-01", "2100-01-01"]
    for first, last in zip(bounds, bounds[1:], strict=False):
        x.where((F.col("date") >= first) & (F.col("date") < last)).coalesce(1).write.mode("append").parquet(root)
    stream = spark.readStream.schema(x.schema).option("maxFilesPerTrigger", 1).parquet(root)
    out, offsets = scratch_path(spark, "turnover"), scratch_path(spark, "offsets")
    ST.carried_turnover(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(ST.DAILY).parquet(out)


@query(
    S.with_(*S.PANEL, S.BOOK)
    + """, s AS (SELECT *, coalesce(weight, 0) AS w, year(date) AS segment FROM book), m AS (SELECT *, abs(w - lag(w, 1, 0.0) OVER (PARTITION BY run_id, segment, symbol ORDER BY date)) AS moved FROM s)
    --result SELECT run_id, segment, date, sum(w * coalesce(return_1d, 0)) AS gross_return, sum(moved) AS turnover FROM m GROUP BY run_id, segment, date""",
    "gross_return turnover",
)
def q_yearly_turnover(spark, d):
    """The same in one batch."""
    return W.segment_turnover(book(spark, d).withColumn("segment", F.year("date")))


# ---- payloads, policies and order ------------------------------------------------------


@query(
    S.with_(S.BARS_SQL)
    + """, c AS (SELECT *, substr(symbol, 2)::INT AS k FROM bars WHERE day(date) != 13)
    --result SELECT symbol, date, open, "max", "min", close, close AS adjclose, CASE WHEN k % 2 = 0 THEN "Trading_Volume" * 10 ELSE "Trading_Volume" END AS "Trading_Volume", "Trading_Volume" AS okx_volume_contract, CASE WHEN k % 2 = 0 THEN "Trading_Volume" * 10 ELSE 0 END AS okx_volume_quote, (k % 3 = 0)::INT AS okx_confirm FROM c""",
    RAW + " okx_volume_contract okx_volume_quote",
)
def q_okx_candles(spark, d):
    """Contract candles of nine fields, half of them without volume in the quote currency; each day has a later one, which stays, and short ones go."""
    k = F.substring("symbol", 2, 2).cast("int")
    text = lambda c: c.cast("string")
    ms = lambda hour: text(F.unix_millis(F.col("date").cast("timestamp")) + hour * 3_600_000)
    volume = F.col("Trading_Volume")
    tail = (F.lit(""), F.when(k % 2 == 0, text(volume * 10)).otherwise(""), F.when(k % 3 == 0, "1").otherwise(""))
    candle = lambda hour, close: F.array(ms(hour), *(text(F.col(c)) for c in ("open", "max", "min")), close, text(volume), *tail)
    full = F.dayofmonth("date") != 13
    x = bars(spark, d).withColumn("c", F.when(full, F.array(candle(1, text(F.col("close"))), candle(0, F.lit("1")))).otherwise(F.array(F.array(ms(0), text(F.col("open"))))))
    landed = x.groupBy("symbol", F.trunc("date", "month").alias("m")).agg(F.to_json(F.flatten(F.collect_list("c"))).alias("payload")).withColumn("ingest_seq", F.lit(1))
    return files.normalize_okx_candles(landed).select("symbol", "date", "open", "max", "min", "close", "adjclose", "Trading_Volume", "okx_volume_contract", "okx_volume_quote", "okx_confirm")


@query(
    S.with_(*S.PANEL)
    + """, f AS (SELECT symbol, date, close IS NOT NULL AND ("Trading_Volume" IS NULL OR "Trading_Volume" > 20) AS with_volume, close IS NOT NULL AS without FROM feats)
    --result SELECT unnest(['fx, no column', 'stock', 'fx', 'optional', 'no column required']) AS case_name, unnest([false, true, true, false, NULL]) AS used, unnest([count(*) FILTER (without), count(*) FILTER (with_volume), count(*) FILTER (with_volume), count(*) FILTER (without), NULL]) AS tradable FROM f"""
)
def q_volume_policy(spark, d):
    """Tradable rows under each policy, with thin days' volume set to zero: volume counts where it is there and wanted, and its lack fails where it is required."""
    x = bars(spark, d).withColumn("Trading_Volume", F.when(F.col("Trading_Volume") > 20, F.col("Trading_Volume")).otherwise(0.0))
    bare = x.drop("Trading_Volume")
    out = None
    for name, rows, policy, market in (("fx, no column", bare, "auto", "fx"), ("stock", x, "auto", "stock"), ("fx", x, "auto", "fx"), ("optional", bare, "optional", "stock"), ("no column required", bare, True, "fx")):
        try:
            used = P.volume_policy(rows, policy, market)
            part = P.features(rows).agg(F.lit(name).alias("case_name"), F.lit(used).alias("used"), F.count_if("tradable").alias("tradable"))
        except ValueError:
            part = spark.createDataFrame([(name, None, None)], "case_name string, used boolean, tradable long")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    """WITH p AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'eurUSD' WHEN 1 THEN 'USDJPY' WHEN 2 THEN o_custkey::VARCHAR ELSE 'C' || o_custkey END AS symbol FROM orders)
    --result SELECT k, symbol, upper(symbol) LIKE '%USD' AS usd, symbol SIMILAR TO '[0-9].*' AS exchange FROM p"""
)
def q_symbol_kinds(spark, d):
    """Pairs quoted in dollars, and codes of an exchange."""
    k = F.col("o_orderkey")
    symbol = F.when(k % 4 == 0, "eurUSD").when(k % 4 == 1, "USDJPY").when(k % 4 == 2, F.col("o_custkey").cast("string")).otherwise(F.concat(F.lit("C"), "o_custkey"))
    x = table(spark, d, "orders").select(k.alias("k"), symbol.alias("symbol"))
    return x.withColumns({"usd": X.is_usd_pair(F.col("symbol")), "exchange": X.is_exchange_code(F.col("symbol"))})


@query(
    """--result SELECT row_number() OVER (ORDER BY o_orderstatus, o_orderpriority, o_orderkey) AS line, o_orderstatus AS status, o_orderpriority AS root, o_orderkey::VARCHAR AS code FROM orders"""
)
def q_report_order(spark, d):
    """A report's lines stand by status, root and code, whatever order its table had."""
    path = scratch_path(spark, "report")
    x = table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("root"), F.col("o_orderkey").alias("code"))
    files.write_report(x.repartition(7), path, ["status", "root", "code"], ["status", "root", "code"])
    # files in the order of their names are the report: lines count within a file, from the lines of the files before
    meta = [F.col("_metadata.file_name").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")]
    back = cut(spark.read.option("header", "true").csv(path).select("*", *meta))
    before = F.sum("n").over(B.Window.orderBy("f").rowsBetween(B.Window.unboundedPreceding, -1))  # one row per file
    offsets = back.groupBy("f").agg(F.count("*").alias("n")).select("f", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(B.Window.partitionBy("f").orderBy("b", "i"))
    return back.join(offsets, "f").select((F.col("before") + place).alias("line"), "status", "root", "code")


@query()
def q_surrogate_ridge(spark, d):
    """Ridge surrogate of the next return on all features."""
    names = list(P.FEATURES)
    return A.surrogate_ridge(panel(spark, d).fillna(0.0, names).where("return_1d is not null"), names, "return_1d")
