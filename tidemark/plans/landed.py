"""Queries of files, lists, series of runs and streams: tables go out to the shared folder and are read back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import expressions as X
from tidemark.functions.scratch import scratch_path
from tidemark.operators import attribution as A
from tidemark.operators import cleaning as C
from tidemark.operators import graph as G
from tidemark.operators import universe as U
from tidemark.plans import sqlparts as S
from tidemark.plans.adapters import bars, table
from tidemark.plans.queries import _EDGES, _ORDERS, _SUPP, ORACLES, RAW, book, communities, edges, flat_edges, order_bars, panel, query, supplier_symbols
from tidemark.sources import files
from tidemark.streaming import bars as ST

# ---- files -------------------------------------------------------------------


@query(S.with_(S.BARS_SQL) + '--result SELECT symbol, date, open, "max", "min", close FROM bars', 'open "max" "min" close')
def q_symbol_files(spark, d):
    """Bars as one folder per symbol, whose name gives the symbol back."""
    root = scratch_path(spark, "symbols")
    x = bars(spark, d).select("date", "open", "max", "min", "close", F.concat("symbol", F.lit("_features.parquet")).alias("file"))
    x.write.partitionBy("file").parquet(root)
    return files.scan_symbol_files(spark, root).select("symbol", "date", "open", "max", "min", "close")


@query(_SUPP + "--result SELECT code, name, tickers FROM s WHERE n % 11 != 0")
def q_symbol_manifest(spark, d):
    path = scratch_path(spark, "manifest")
    blank = F.when(F.col("n") % 2 == 0, " ")
    files.write_table(supplier_symbols(spark, d).select(F.when(F.col("n") % 11 != 0, F.col("code")).otherwise(blank).alias("code"), "name", "tickers"), path, "csv")
    return files.read_symbol_manifest(spark, path)


@query("--result SELECT DISTINCT 'C' || (c_custkey % 500) AS code FROM customer WHERE c_custkey % 7 != 0 AND c_custkey % 5 != 0")
def q_symbol_list(spark, d):
    path = scratch_path(spark, "list")
    k = F.col("c_custkey")
    line = F.when(k % 7 == 0, F.concat(F.lit("# "), k)).when(k % 5 == 0, "  ").otherwise(F.concat(F.lit(" C"), k % 500))
    table(spark, d, "customer").select(line.alias("value")).write.text(path)
    return files.read_symbol_list(spark, path)


@query(
    """WITH p AS (SELECT DISTINCT translate((p_partkey % 900)::VARCHAR, '0123456789', 'ABCDEFGHIJ') AS t, p_partkey % 900 AS k FROM part)
    --result SELECT t AS ticker, 'Company ' || t AS name FROM p WHERE k % 4 != 0 AND k % 6 != 1"""
)
def q_listing_directory(spark, d):
    path = scratch_path(spark, "listing")
    k = F.col("p_partkey") % 900
    t = F.translate(k.cast("string"), "0123456789", "ABCDEFGHIJ")
    rows = table(spark, d, "part").select(F.when(k % 6 == 1, F.lower(t)).otherwise(t).alias("Symbol"), F.concat(F.lit("Company "), t).alias("Security Name"), F.when(k % 4 == 0, "Y").otherwise("N").alias("Test Issue"))
    rows.write.option("sep", "|").option("header", "true").csv(path)
    return files.read_listing_directory(spark, path)


def market(symbol: Column) -> Column:
    return F.when(symbol.endswith("1"), "first").otherwise("second")


@query(S.with_(S.BARS_SQL) + "--result SELECT symbol, date, CASE WHEN symbol LIKE '%1' THEN 'first' ELSE 'second' END AS market, CASE WHEN symbol LIKE '%1' THEN close * 2 ELSE close END AS close FROM bars", "close")
def q_write_bars(spark, d):
    """All markets written, then one of them replaced."""
    path = scratch_path(spark, "bars")
    x = bars(spark, d).select("symbol", "date", "close", market(F.col("symbol")).alias("market"))
    files.write_bars(x, path)
    files.write_bars(x.where("market = 'first'").withColumn("close", F.col("close") * 2), path)
    return spark.read.parquet(path).select("symbol", "date", "market", "close")


@query("WITH f AS (SELECT * FROM (VALUES ('csv'), ('parquet')) t(fmt))--result SELECT fmt, o_orderkey, o_orderstatus, o_totalprice::DOUBLE AS price FROM orders, f", "price")
def q_table_formats(spark, d):
    x = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("price"))
    paths = {fmt: scratch_path(spark, fmt) for fmt in ("csv", "parquet")}
    for fmt, path in paths.items():
        files.write_table(x, path, fmt)
    back = {"csv": spark.read.schema(x.schema).option("header", "true").csv(paths["csv"]), "parquet": spark.read.parquet(paths["parquet"])}
    rows = [df.select(F.lit(fmt).alias("fmt"), *x.columns) for fmt, df in back.items()]
    return rows[0].unionByName(rows[1])


@query("--result SELECT o_orderkey::VARCHAR AS o_orderkey, '[' || o_custkey || ',' || o_orderkey || ']' AS keys, '{\"s\":\"' || o_orderstatus || '\",\"c\":' || o_custkey || '}' AS fields FROM orders")
def q_nested_csv(spark, d):
    path = scratch_path(spark, "nested")
    x = table(spark, d, "orders").select("o_orderkey", F.array("o_custkey", "o_orderkey").alias("keys"), F.struct(F.col("o_orderstatus").alias("s"), F.col("o_custkey").alias("c")).alias("fields"))
    files.export_nested_csv(x, path)
    return spark.read.option("header", "true").csv(path)


@query(f"WITH a AS ({ORACLES['q_audit_bars']})--result SELECT status, count(*) AS count FROM a GROUP BY status")
def q_run_summary(spark, d):
    path = scratch_path(spark, "summary")
    files.write_summary(C.status_counts(C.audit(order_bars(spark, d))), path)
    return spark.read.schema("status string, count long").json(path)


REPORT = ["symbol", "status", "rows", "first_date", "last_date", "duplicate_dates", "stale_days", "issues"]


@query(f"WITH a AS ({ORACLES['q_audit_bars']})--result SELECT {', '.join(f'{c}::VARCHAR AS {c}' for c in REPORT)} FROM a")
def q_audit_report(spark, d):
    path = scratch_path(spark, "report")
    files.write_report(C.audit(order_bars(spark, d)), path, REPORT, ["symbol"])
    return spark.read.option("header", "true").csv(path)


@query(_EDGES + f"--result SELECT source, {', '.join(f'''sum(weight) FILTER (target = 'N{i}') AS N{i}''' for i in range(25))} FROM edges GROUP BY source", " ".join(f"N{i}" for i in range(25)))
def q_flow_matrix(spark, d):
    return files.matrix(edges(spark, d), "weight", [f"N{i}" for i in range(25)])


# ---- landed rows ---------------------------------------------------------------


@query(_ORDERS + '--result SELECT symbol, date, open, "max", "min", close, open * 2 AS "Open_1", ingest_seq FROM ob', 'open "max" "min" close "Open_1"')
def q_vendor_columns(spark, d):
    """Vendor names with a header that repeats, brought to the names of bars."""
    x = order_bars(spark, d).select("symbol", "date", "open", "max", "min", "close", F.col("open") * 2, "ingest_seq")
    vendor = x.toDF("symbol", "Date", "Open", "High", "Low", "Close", "Open", "ingest_seq")
    return C.rename_vendor_columns(C.dedupe_column_names(vendor))


@query(
    _ORDERS + """, t AS (SELECT symbol, date, open, "max", "min", close, CASE WHEN ingest_seq % 6 = 0 THEN NULL ELSE adjclose END AS adjclose, "Trading_Volume", ingest_seq FROM ob),
    kept AS (SELECT *, 'column' AS adjusted FROM t WHERE adjclose IS NOT NULL UNION ALL SELECT * REPLACE (close AS adjclose), 'none' FROM t)
    --result SELECT adjusted, symbol, date, open, "max", "min", close, adjclose, "Trading_Volume"::BIGINT AS "Trading_Volume"
    FROM kept WHERE close IS NOT NULL QUALIFY row_number() OVER (PARTITION BY adjusted, symbol, date ORDER BY ingest_seq DESC) = 1""",
    'open "max" "min" close adjclose',
)
def q_canonical_strict(spark, d):
    """With a column of adjusted closes that has gaps, and without the column."""
    x = order_bars(spark, d).withColumn("adjclose", F.when(F.col("ingest_seq") % 6 != 0, F.col("adjclose")))
    parts = [C.canonical_strict(rows).withColumn("adjusted", F.lit(name)).select("adjusted", "symbol", "date", "open", "max", "min", "close", "adjclose", "Trading_Volume") for name, rows in (("column", x), ("none", x.drop("adjclose")))]
    return parts[0].unionByName(parts[1])


@query("--result SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 OR p_partkey % 2 = 0 THEN 2 ELSE 8 END::INT AS decimals FROM part")
def q_price_decimals(spark, d):
    k = F.col("p_partkey")
    symbol = F.when(k % 2 == 0, k.cast("string")).otherwise(F.concat(F.lit("P"), k))
    return table(spark, d, "part").select("p_partkey", X.price_decimals(symbol, F.when(k % 3 == 0, "tw").otherwise("us")).alias("decimals"))


@query(
    """WITH t AS (SELECT translate((c_custkey % 4000)::VARCHAR, '0123456789', 'abcdefghXj') AS symbol, CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE 'Coin ' || c_custkey END AS name, c_custkey AS k FROM customer)
    --result SELECT upper(symbol) || 'USD' AS code, coalesce(nullif(trim(name), ''), upper(symbol)) AS name, upper(symbol) || '-USD' AS ticker FROM t WHERE regexp_full_match(symbol, '[a-z]{2,8}') QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY k) = 1"""
)
def q_crypto_universe(spark, d):
    """Coins whose symbols repeat, are too short, or hold a capital."""
    k = F.col("c_custkey")
    coins = table(spark, d, "customer").select(F.translate((k % 4000).cast("string"), "0123456789", "abcdefghXj").alias("symbol"), F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("Coin "), k)).alias("name"), k.alias("ingest_seq"))
    return U.crypto_universe(coins)


@query(
    """WITH t AS (SELECT c_custkey AS code, chr((65 + c_custkey % 3)::INT) || 'BCDE' || chr((65 + c_custkey % 5)::INT) AS p, c_custkey % 4 AS m FROM customer),
    l AS (SELECT code, CASE m WHEN 0 THEN [p || '=X'] WHEN 1 THEN [lower(p) || '=x', 'spot'] WHEN 2 THEN [p || '=X', substr(p, 4, 3) || substr(p, 1, 3) || '=X'] ELSE [p] END AS ts, p, m FROM t)
    --result SELECT code, unnest(ts || CASE WHEN m < 2 THEN [substr(p, 4, 3) || substr(p, 1, 3) || '=X'] ELSE [] END) AS ticker FROM l"""
)
def q_fx_tickers(spark, d):
    """FX tickers and their inverses; lists that hold the inverse already, and pairs without the ending, get none."""
    k = F.col("c_custkey")
    letter = lambda n: F.char(65 + k % n)
    x = table(spark, d, "customer").select(k.alias("code"), F.concat(letter(3), F.lit("BCDE"), letter(5)).alias("p"), (k % 4).alias("m"))
    turned = F.concat(F.substring("p", 4, 3), F.substring("p", 1, 3), F.lit("=X"))
    tickers = F.when(F.col("m") == 0, F.concat("p", F.lit("=X"))).when(F.col("m") == 1, F.concat(F.lower("p"), F.lit("=x, spot"))).when(F.col("m") == 2, F.concat("p", F.lit("=X, "), turned)).otherwise(F.col("p"))
    return U.candidate_tickers(x.select("code", tickers.alias("tickers")), fx=True).select("code", "ticker")


@query(
    """--result SELECT 'okx' AS venue, 'P' || p_partkey || 'USDT' AS code FROM part WHERE p_partkey % 3 = 0
    UNION ALL SELECT 'bybit', 'Q' || p_partkey FROM part WHERE p_partkey % 4 != 0 AND p_partkey % 5 != 0"""
)
def q_listed_instruments(spark, d):
    k = F.col("p_partkey")
    okx = table(spark, d, "part").select(F.concat(F.lit("P"), k, F.lit("-USDT")).alias("inst_id"), F.when(k % 3 == 0, "live").otherwise("suspend").alias("state"))
    bybit = table(spark, d, "part").select(F.concat(F.lit("Q"), k).alias("symbol"), F.when(k % 4 != 0, "Trading").otherwise("Closed").alias("status"), F.when(k % 5 != 0, "LinearPerpetual").otherwise("LinearFutures").alias("contract_type"))
    return U.listed_instruments(okx).select(F.lit("okx").alias("venue"), "code").unionByName(U.listed_instruments(bybit, "bybit").select(F.lit("bybit").alias("venue"), "code"))


_MOVES = """, m AS (SELECT symbol, date AS raw_date, lead(date) OVER s AS raw_next_date, ln(lead(close) OVER s / close) AS move FROM bars WINDOW s AS (PARTITION BY symbol ORDER BY date)),
    x AS (SELECT * FROM m WHERE abs(move) >= 0.05 AND day(raw_date) NOT IN (1, 2, 3))"""


def moves(spark, d):
    """Investigated moves as text: dividends on first days of a month, splits on second, gains on third ones."""
    w = C.series_window()
    ahead = F.lead("close").over(w)
    on = lambda n: F.when(F.dayofmonth("date") == n, "0.5").when(F.dayofmonth("date") == 9, "0").alias
    return bars(spark, d).select(
        "symbol", F.col("date").alias("raw_date"), F.lead("date").over(w).alias("raw_next_date"), F.ln(ahead / F.col("close")).cast("string").alias("raw_close_logret"), F.lit("").alias("adjclose_logret"), on(1)("dividends"), on(2)("stock_splits"), on(3)("capital_gains")
    )


@query(S.with_(S.BARS_SQL) + _MOVES + "--result SELECT symbol, raw_date, raw_next_date FROM x")
def q_candidate_extremes(spark, d):
    return C.candidate_extremes(moves(spark, d), 0.05).select("symbol", "raw_date", "raw_next_date")


@query(S.with_(S.BARS_SQL) + _MOVES + "--result SELECT symbol, raw_date AS date FROM x UNION SELECT symbol, raw_next_date FROM x")
def q_event_targets(spark, d):
    return C.event_targets(C.candidate_extremes(moves(spark, d), 0.05))


@query("--result SELECT o_orderkey, least(greatest(trunc((o_totalprice::DOUBLE - 50000) * 1e14::DOUBLE), -pow(2, 62)), pow(2, 62))::BIGINT AS clipped FROM orders")
def q_int64_clip(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.int64_clip((F.col("o_totalprice").cast("double") - 50000) * 1e14).alias("clipped"))


@query(
    """WITH o AS (SELECT o_orderkey % 3 AS p, o_orderkey % 5 AS f, o_orderkey % 7 AS m FROM orders)
    --result SELECT status, count(*) AS n FROM (SELECT CASE WHEN f < 2 THEN CASE p WHEN 1 THEN 'new_symbol_repaired' WHEN 0 THEN 'schema_repaired' ELSE 'repaired' END WHEN f = 2 AND m IN (0, 1, 2) THEN 'not_found' WHEN f = 2 THEN 'failed' WHEN f = 3 THEN 'still_stale' ELSE 'up_to_date' END AS status FROM o) GROUP BY status"""
)
def q_final_status(spark, d):
    """Fetches of every outcome, whose messages may say that a symbol is gone; only a failed one heeds them."""
    k = F.col("o_orderkey")
    plan = F.when(k % 3 == 0, "schema_mismatch").when(k % 3 == 1, "new_symbol").otherwise("stale")
    fetched = F.when(k % 5 < 2, "updated").when(k % 5 == 2, "failed").when(k % 5 == 3, "empty").otherwise("up_to_date")
    said = F.when(k % 7 == 0, "$X: Possibly Delisted; No timezone found").when(k % 7 == 1, "Quote not found for symbol: X").when(k % 7 == 2, "No price data found (1d)").when(k % 7 == 3, "timed out").when(k % 7 == 4, "symbol not found")
    return table(spark, d, "orders").groupBy(C.final_status(plan, fetched, said).alias("status")).agg(F.count("*").alias("n"))


@query(
    f"WITH a AS ({ORACLES['q_audit_bars']}), r AS (SELECT first_date, CASE WHEN symbol LIKE '%3' THEN DATE '1999-01-04' ELSE last_date END AS last_date FROM a)--result SELECT min(first_date) AS oldest, max(last_date) AS newest, count(last_date) AS tracked, datediff('day', max(last_date), DATE '1999-02-01')::INT AS lag_days FROM r"
)
def q_coverage(spark, d):
    """Coverage after a repair that reached symbols ending in 3; those ending in 4 stayed stale."""
    a = C.audit(order_bars(spark, d))
    fixed = a.where("symbol like '%3' or symbol like '%4'").select("symbol", F.when(F.col("symbol").endswith("3"), "repaired").otherwise("still_stale").alias("status"), F.when(F.col("symbol").endswith("3"), F.to_date(F.lit("1999-01-04"))).otherwise(F.to_date(F.lit("2030-01-01"))).alias("last_date"))
    return C.coverage(a, F.to_date(F.lit("1999-02-01")), fixed)


# ---- symbols -------------------------------------------------------------------


@query(S.with_(*S.PANEL) + ", c AS (SELECT symbol FROM (SELECT DISTINCT symbol FROM feats WHERE symbol IN ('N3', 'N7', 'N4')) ORDER BY list_position(['N3', 'N7', 'N4'], symbol) LIMIT 1)--result SELECT date, return_1d AS benchmark_return FROM feats JOIN c USING (symbol)", "benchmark_return")
def q_symbol_benchmark(spark, d):
    return U.symbol_benchmark(panel(spark, d), ["BTC", "n3", "N7", "N4"])


@query(
    """WITH c AS (SELECT DISTINCT 'A' || lpad(s_nationkey::VARCHAR, 2, '0') AS c FROM supplier), p AS (SELECT c_custkey, 'A' || lpad(c_nationkey::VARCHAR, 2, '0') AS b, 'A' || lpad((c_custkey % 60)::VARCHAR, 2, '0') AS q FROM customer)
    --result SELECT c_custkey, b || q AS pair FROM p WHERE b IN (SELECT c FROM c) AND q IN (SELECT c FROM c)"""
)
def q_supported_pairs(spark, d):
    name = lambda x: F.concat(F.lit("A"), F.lpad(x.cast("string"), 2, "0"))
    pairs = table(spark, d, "customer").select("c_custkey", F.concat(name(F.col("c_nationkey")), name(F.col("c_custkey") % 60)).alias("pair"))
    return U.supported_pairs(pairs, table(spark, d, "supplier").select(name(F.col("s_nationkey")).alias("currency")))


_TRACKED = """WITH c AS (SELECT c_custkey AS k, translate((c_custkey % 700)::VARCHAR, '0123456789', 'abcdefghij') AS w FROM customer),
    l AS (
      SELECT 'crypto' AS asset, w || 'usd' AS code, k FROM c WHERE k % 2 = 0 UNION ALL SELECT 'forex', w || 'xyz', k FROM c WHERE k % 2 = 0 UNION ALL SELECT 'tw', ' ' || lpad((k % 3000)::VARCHAR, 4 + (k % 3)::INT, '0'), k FROM c WHERE k % 2 = 0 UNION ALL SELECT 'stock', w, k FROM c WHERE k % 2 = 0
    ), own AS (SELECT DISTINCT asset, upper(trim(code)) AS code FROM l),
    m AS (SELECT DISTINCT asset, code, 'Name of ' || code AS name, 'M' AS market, code || '-M' AS tickers FROM own WHERE length(code) % 2 = 0),
    listed AS (SELECT o.asset, o.code, coalesce(m.name, o.code) AS name, coalesce(m.market, o.asset) AS market,
        coalesce(m.tickers, CASE o.asset WHEN 'crypto' THEN replace(o.code || '|', 'USD|', '-USD') WHEN 'tw' THEN o.code || '.TW,' || o.code || '.TWO' ELSE o.code END) AS tickers, 'local' AS origin
      FROM own o LEFT JOIN m USING (asset, code) WHERE m.code IS NOT NULL OR o.asset IN ('crypto', 'stock') OR o.asset = 'tw' AND regexp_full_match(o.code, '[0-9]{4}[A-Z]?|00[0-9A-Z]{3,4}')),
    given AS (
      SELECT DISTINCT 'crypto' AS asset, upper(w) || 'USD' AS code, upper(w) || '-USD' AS tickers FROM c WHERE k % 3 = 0 UNION SELECT 'forex', upper(w) || 'EUR', upper(w) || 'EUR=X' FROM c WHERE k % 3 = 0
      UNION SELECT 'tw', (k % 2000)::VARCHAR, min((k % 2000)::VARCHAR || CASE WHEN k % 2 = 0 THEN '.TWO' ELSE '.TW' END) FROM c WHERE k % 3 = 0 GROUP BY ALL UNION SELECT 'stock', upper(w), upper(w) FROM c WHERE k % 3 = 0
    ), wanted AS (SELECT g.asset, g.code, coalesce(m.name, g.code) AS name, coalesce(m.market, g.asset) AS market, coalesce(m.tickers, g.tickers) AS tickers, 'whitelist' AS origin FROM given g ANTI JOIN listed USING (asset, code) LEFT JOIN m USING (asset, code))
    --result SELECT asset, code, name, market, tickers, origin FROM listed UNION ALL SELECT asset, code, name, market, tickers, origin FROM wanted"""


@query(_TRACKED)
def q_tracked_symbols(spark, d):
    """Coins, pairs, an exchange's codes and shares: files at hand, a manifest that knows half of them, and a whitelist of tickers."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.translate((F.col("c_custkey") % 700).cast("string"), "0123456789", "abcdefghij").alias("w"))
    k, w = F.col("k"), F.col("w")
    even, third = c.where("k % 2 = 0"), c.where("k % 3 = 0")
    files_at_hand = {"crypto": F.concat(w, F.lit("usd")), "forex": F.concat(w, F.lit("xyz")), "tw": F.concat(F.lit(" "), F.lpad((k % 3000).cast("string"), (k % 3 + 4).cast("int"), F.lit("0"))), "stock": w}
    tickers = {
        "crypto": F.when(k % 2 == 0, F.concat(w, F.lit("-usd"))).otherwise(w), "forex": F.concat(w, F.lit("eur"), F.when(k % 2 == 0, "=X").otherwise("")),
        "tw": F.concat((k % 2000).cast("string"), F.when(k % 2 == 0, ".two").otherwise("")), "stock": w,
    }
    out = None
    for asset in files_at_hand:
        local = even.select(files_at_hand[asset].alias("code"))
        code = F.upper(F.trim("code"))
        manifest = local.select(code.alias("code"), F.concat(F.lit("Name of "), code).alias("name"), F.lit("M").alias("market"), F.concat(code, F.lit("-M")).alias("tickers")).where(F.length("code") % 2 == 0)
        part = U.tracked_symbols(local, manifest, third.select(tickers[asset].alias("ticker")), asset).withColumn("asset", F.lit(asset))
        out = part if out is None else out.unionByName(part)
    return out.select("asset", "code", "name", "market", "tickers", "origin")


@query(S.with_(*S.PANEL, S.BOOK) + "--result SELECT symbol, avg(abs(weight)) + 0.05 * avg(abs(score)) AS value FROM book GROUP BY symbol HAVING bool_or(tradable) ORDER BY value DESC, symbol LIMIT 8", "value")
def q_select_symbols(spark, d):
    return A.select_symbols(book(spark, d), 8)


# ---- runs, epochs, dates -------------------------------------------------------


_CURVES = ", curves AS (SELECT symbol AS run, (year(date) * 12 + month(date))::INT AS epoch, min(close) AS val_mean FROM bars GROUP BY ALL)"


def curves(spark, d):
    """A curve per symbol: the least close of each month."""
    return bars(spark, d).groupBy(F.col("symbol").alias("run"), (F.year("date") * 12 + F.month("date")).alias("epoch")).agg(F.min("close").alias("val_mean"))


@query(
    S.with_(S.BARS_SQL).replace("WITH", "WITH RECURSIVE", 1) + _CURVES + """, noted AS (SELECT run, epoch, CASE WHEN epoch % 4 = 1 THEN NULL WHEN epoch % 9 = 3 THEN 'nan'::DOUBLE ELSE val_mean END AS v, CASE WHEN epoch % 31 = 7 THEN epoch % 6 WHEN epoch % 31 = 9 THEN -1 END AS g FROM curves),
    used AS MATERIALIZED (SELECT run, CASE WHEN isfinite(v) THEN v END AS v, CASE WHEN g >= 0 THEN g END AS g, row_number() OVER (PARTITION BY run ORDER BY epoch) AS i FROM noted WHERE g >= 0 OR v IS NOT NULL AND isfinite(v)),
    walk(run, i, best, n) AS (
      SELECT DISTINCT run, 0::BIGINT, 'inf'::DOUBLE, 0::BIGINT FROM noted
      UNION ALL SELECT u.run, u.i, least(best, coalesce(v, best)), CASE WHEN g IS NOT NULL THEN g WHEN v < best THEN 0 ELSE n + 1 END FROM walk w JOIN used u ON u.run = w.run AND u.i = w.i + 1)
    --result SELECT run, arg_max(n, i) AS no_improve FROM walk GROUP BY run"""
)
def q_no_improve_epochs(spark, d):
    """Curves with missing losses and with epochs that carry a counter of their own."""
    e = F.col("epoch")
    x = curves(spark, d).withColumns({"val_mean": F.when(e % 4 == 1, None).when(e % 9 == 3, float("nan")).otherwise(F.col("val_mean")), "no_improve": F.when(e % 31 == 7, e % 6).when(e % 31 == 9, -1)})
    return A.no_improve_epochs(x, counter="no_improve")


@query(
    S.with_(S.BARS_SQL) + _CURVES + """--result SELECT run, epoch, CASE WHEN substr(run, 2)::INT % 2 = 0 THEN val_mean * 2 WHEN epoch % 5 = 0 THEN NULL ELSE val_mean END AS val_mean FROM curves""",
    "val_mean",
)
def q_epoch_curves(spark, d):
    """A folder of curve files per run; half of the runs have a newer file of another kind, which wins."""
    root = scratch_path(spark, "curves")
    x = curves(spark, d)
    x.withColumn("val_mean", F.when(F.col("epoch") % 5 == 0, float("nan")).otherwise(F.col("val_mean"))).write.partitionBy("run").parquet(root)
    x.where("substr(run, 2) % 2 = 0").withColumn("val_mean", F.col("val_mean") * 2).repartition("run").write.mode("append").partitionBy("run").json(root)
    return files.read_epoch_curves(spark, root).select(F.regexp_extract("run", "^run=(.*)$", 1).alias("run"), F.col("epoch").cast("int").alias("epoch"), "val_mean")


@query(S.with_(S.BARS_SQL) + _CURVES + "--result SELECT * FROM curves QUALIFY epoch % 5 = 0 OR epoch = max(epoch) OVER (PARTITION BY run)", "val_mean")
def q_sample_epochs(spark, d):
    return A.sample_epochs(curves(spark, d), 5)


_GRID = ", e AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS c FROM (SELECT DISTINCT date FROM bars))"


@query(
    S.with_(S.BARS_SQL) + _GRID + """, n AS (SELECT 'even' AS how, date FROM e WHERE i IN (SELECT floor(k * (c - 1) / 39.0)::BIGINT FROM range(40) t(k), (SELECT any_value(c) AS c FROM e)) UNION ALL SELECT 'first', date FROM e WHERE i < 40 UNION ALL SELECT 'last', date FROM e WHERE i >= c - 40)
    --result SELECT how, symbol, date, close FROM bars JOIN n USING (date)""",
    "close",
)
def q_sample_dates(spark, d):
    x = bars(spark, d).select("symbol", "date", "close")
    parts = [A.sample_dates(x, how, 40).withColumn("how", F.lit(how)) for how in ("even", "first", "last")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- flows and flags -----------------------------------------------------------


@query(
    _EDGES + """, n AS (SELECT 'N' || n_nationkey AS node, n_regionkey AS token FROM nation), batches AS (SELECT DISTINCT shock, substr(shock, 1, 1) < 'G' AS early FROM edges),
    sizes AS (SELECT early, count(*) AS b FROM batches GROUP BY early),
    i AS (SELECT early, source, token, sum(weight) / any_value(b) AS a FROM edges JOIN n ON node = target JOIN batches USING (shock) JOIN sizes USING (early) GROUP BY ALL),
    o AS (SELECT token, target, sum(weight) / (SELECT count(*) FROM batches) AS b FROM edges JOIN n ON node = source WHERE token != 0 GROUP BY ALL),
    f AS (SELECT source, target, sum(a * b) AS flow FROM i JOIN o USING (token) GROUP BY ALL UNION ALL SELECT source, target, sum(weight) / (SELECT count(*) FROM batches) FROM edges GROUP BY ALL)
    --result SELECT source, target, sum(flow) / ((SELECT count(*) FROM sizes) + 1) AS flow FROM f GROUP BY ALL""",
    "flow",
)
def q_compose_flow(spark, d):
    """Trade between nations by way of regions and direct: two captures into regions, one out of them that lacks a region, and a direct one, each with a batch per market segment."""
    e, c = edges(spark, d).withColumnRenamed("shock", "batch"), communities(spark, d).withColumnRenamed("community", "token")
    into = e.join(c.withColumnRenamed("node", "target"), "target").groupBy("batch", "source", "token").agg(F.sum("weight").alias("weight")).withColumn("capture", F.substring("batch", 1, 1) < "G")
    out = e.join(c.withColumnRenamed("node", "source"), "source").where("token != 0").groupBy("batch", "token", "target").agg(F.sum("weight").alias("weight")).withColumn("capture", F.lit("out"))
    return G.compose_flow(into, out, e.withColumn("capture", F.lit("direct")))


_FIGURES = {
    "untradable_weight": "min(weight) / sum(weight) / 100", "net_exposure": "min(weight) / max(weight) + 0.26", "max_weight": "max(weight) / avg(weight)", "turnover": "sum(weight) / avg(weight) / 400",
    "top_feature_share": "avg(weight) / max(weight)", "top_lookback_share": "max(weight) / sum(weight) + 0.6", "correlation": "min(weight) / avg(weight) + 0.7", "zero_fraction": "max(weight) / sum(weight)",
}


def figures(spark, d):
    return flat_edges(spark, d).agg(*(F.expr(e).alias(n) for n, e in _FIGURES.items()))


_FIGURES_SQL = f", m AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _FIGURES.items())} FROM flat)"


@query(
    _EDGES + _FIGURES_SQL + "--result " + " UNION ALL ".join(f"SELECT '{n}' AS rule, {n} AS value, {t}::DOUBLE AS threshold, CASE WHEN abs({n}) > {t} THEN 'warn' ELSE 'pass' END AS status FROM m" for n, t in A.STABILITY_RULES.items()),
    "value threshold",
)
def q_stability_flags(spark, d):
    """All seven rules on figures of a trade graph."""
    return A.stability_flags(figures(spark, d))


@query(
    _EDGES + _FIGURES_SQL + ", w AS ("
    + " UNION ALL ".join(f"SELECT {i} AS i, '{text.replace(chr(39), chr(39) * 2)}' AS warning FROM m WHERE abs({n}) > {A.STABILITY_RULES.get(n, A.NET_EXPOSURE)}" for i, (n, text) in enumerate(A.WARNINGS.items()))
    + ")--result SELECT (row_number() OVER (ORDER BY i) - 1)::INT AS place, warning FROM w"
)
def q_stability_warnings(spark, d):
    return A.stability_warnings(figures(spark, d))


# ---- streams -------------------------------------------------------------------


def landed_stream(spark, d):
    """Order bars as a stream of files."""
    path = scratch_path(spark, "landed")
    x = order_bars(spark, d).where("close is not null")
    x.write.parquet(path)
    return spark.readStream.schema(x.schema).parquet(path)


@query(_ORDERS + "--result SELECT DISTINCT symbol, date FROM ob WHERE close IS NOT NULL")
def q_stream_unique_bars(spark, d):
    """Each symbol's days once, by a stream with state; no row is late in its one batch."""
    out = scratch_path(spark, "unique")
    rows = ST.drop_late_duplicates(landed_stream(spark, d).select("symbol", F.col("date").cast("timestamp").alias("date")))
    rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "offsets")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("symbol string, date timestamp").parquet(out).select("symbol", F.to_date("date").alias("date"))


@query(
    _ORDERS + "--result SELECT symbol, date, close, ingest_seq FROM ob WHERE close IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ingest_seq DESC) = 1", "close"
)
def q_stream_merge(spark, d):
    """Landed bars merged into a table by month, the last row of a day winning."""
    path = scratch_path(spark, "merged")
    ST.merge_stream(landed_stream(spark, d), path, scratch_path(spark, "offsets")).awaitTermination()
    return spark.read.parquet(path).select("symbol", "date", "close", "ingest_seq")
