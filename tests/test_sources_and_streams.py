"""Files in and out, snapshots, payloads and streams."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning as C
from tidemark.operators import universe as U
from tidemark.sources import files
from tidemark.streaming import bars as ST


def test_symbol_files_and_snapshot(spark, tmp_path):
    for s, n in (("AAA", 3), ("BBB", 2)):
        spark.range(n).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("date"), F.lit(1.0).alias("close")).coalesce(1).toPandas().to_parquet(tmp_path / f"{s}_features.parquet")
    got = files.scan_symbol_files(spark, str(tmp_path)).groupBy("symbol").count().collect()
    assert {r.symbol: r["count"] for r in got} == {"AAA": 3, "BBB": 2}
    build = lambda: files.scan_symbol_files(spark, str(tmp_path))
    saved = str(tmp_path / "saved")
    glob = f"{tmp_path}/*_features.parquet"
    assert files.panel_snapshot(spark, glob, saved, "v", build)[1] is False
    assert files.panel_snapshot(spark, glob, saved, "v", build)[1] is True
    assert files.panel_snapshot(spark, glob, saved, "other", build)[1] is False


def test_coverage_after_repairs(spark):
    day = lambda n: dt.date(2024, 1, n)
    audited = spark.createDataFrame([("a", "ok", day(1), day(9)), ("b", "broken", day(1), day(20)), ("c", "ok", day(2), day(8)), ("d", "failed", None, None)], "symbol string, status string, first_date date, last_date date")
    fixed = spark.createDataFrame([("c", "repaired", day(12)), ("a", "still_stale", day(30))], "symbol string, status string, last_date date")
    as_of = F.lit(day(15))
    assert C.coverage(audited, as_of).first() == (day(1), day(20), 3, -5)
    assert C.coverage(audited, as_of, fixed).first() == (day(1), day(12), 2, 3)
    assert C.coverage(audited.where("symbol = 'd'"), as_of, fixed).first() == (None, None, 0, None)


def test_listing_manifest_and_lists(spark, tmp_path):
    (tmp_path / "l.txt").write_text("Symbol|Security Name|Test Issue\nAAA|A|N\nZZZ|Z|Y\nAAA|A|N\nFile Creation Time: 1||\n")
    assert [r.ticker for r in files.read_listing_directory(spark, str(tmp_path / "l.txt")).collect()] == ["AAA"]
    (tmp_path / "w.txt").write_text("# note\n\nAAA\nAAA\nBBB\n")
    assert sorted(r.code for r in files.read_symbol_list(spark, str(tmp_path / "w.txt")).collect()) == ["AAA", "BBB"]


def test_tables_out(spark, tmp_path):
    with pytest.raises(ValueError):
        files.write_table(spark.range(1), str(tmp_path / "x"), "xls")
    nested = spark.createDataFrame([(1, [1, 2])], "a int, b array<int>")
    files.export_nested_csv(nested, str(tmp_path / "n"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "n")).first().b == "[1,2]"
    files.export_nested_csv(nested.limit(0), str(tmp_path / "e"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "e")).columns == ["a", "b"]
    days = spark.createDataFrame([("tw", 1), ("us", 2)], "market string, x int")
    files.write_bars(days, str(tmp_path / "bars"))
    files.write_bars(days.where("market = 'us'").withColumn("x", F.lit(9)), str(tmp_path / "bars"))
    assert {r.market: r.x for r in spark.read.parquet(str(tmp_path / "bars")).collect()} == {"tw": 1, "us": 9}


def test_candles(spark):
    payload = '[["1704067200000","1","2","0.5","1.5","10","100","1000","1"],["1704067200000","1","2","0.5","1.6","10"],["1","2"]]'
    landed = spark.createDataFrame([("S", payload, 1)], "symbol string, payload string, ingest_seq long")
    assert [(r.Trading_Volume, r.okx_volume_contract, r.okx_confirm, str(r.date)) for r in files.normalize_okx_candles(landed).collect()] == [(1000.0, 10.0, 1, "2024-01-01")]
    assert files.normalize_bybit_candles(landed).first().Trading_Volume == 10


def test_epoch_curves(spark, tmp_path):
    spark.createDataFrame([(0, 1.0), (1, float("nan"))], "epoch int, val_mean double").coalesce(1).toPandas().to_parquet(tmp_path / "one.parquet")
    (tmp_path / "two.jsonl").write_text('{"epoch": 0, "val_mean": 2.0}\n{"epoch": 1, "val_mean": 1.5}\n')
    for run, loss in (("a/fold_1", 5.0), ("b/fold_1", 6.0)):
        (tmp_path / run).mkdir(parents=True)
        (tmp_path / run / "epoch_curve.csv").write_text(f"epoch,val_mean\n3,{loss + 10}\n")
        time.sleep(0.05)
        (tmp_path / run / "epoch_curve.jsonl").write_text('{"epoch": 3, "val_mean": %s}\n' % loss)
    got = files.read_epoch_curves(spark, str(tmp_path)).collect()
    want = {("one", 0): 1.0, ("one", 1): None, ("two", 0): 2.0, ("two", 1): 1.5, ("a/fold_1", 3): 5.0, ("b/fold_1", 3): 6.0}
    assert {(r.run, r.epoch): r.val_mean for r in got} == want and len(got) == len(want)


def test_audit_finds_injected_faults(spark):
    d = dt.date(2024, 1, 1)
    rows = [("ok", d, 1.0, 2.0, 0.5, 1.5, 1.0), ("bad", d, 1.0, 0.5, 2.0, 1.5, 1.0), ("dup", d, 1.0, 2.0, 0.5, 1.5, 1.0), ("dup", d, 1.0, 2.0, 0.5, 1.5, 1.0), ("null", d, 1.0, 2.0, 0.5, None, 1.0), ("neg", d, 1.0, 2.0, 0.5, 1.5, -1.0)]
    got = {r.symbol: (r.issues, r.status) for r in C.audit(spark.createDataFrame(rows, "symbol string, date date, open double, max double, min double, close double, Trading_Volume double")).collect()}
    assert got == {"ok": ("", "ok"), "bad": ("bad_ohlc", "warn"), "dup": ("duplicate_dates", "warn"), "null": ("nan_ohlc", "warn"), "neg": ("negative_volume", "warn")}
    texts = [("a", "2024-01-01"), ("a", "nonsense"), ("b", "nonsense"), ("c", "2024-01-01"), ("c", "2024-01-02"), ("c", "2024-01-03"), ("c", "2024-02-01"), ("c", "2024-02-01")]
    got = {r.symbol: r for r in C.audit(spark.createDataFrame([(s, d, 1.0) for s, d in texts], "symbol string, date string, close double"), F.to_date(F.lit("2024-02-01"))).collect()}
    assert (got["a"].issues, got["a"].status, got["a"].invalid_dates) == ("invalid_dates|missing_columns|stale", "warn", 1)
    assert (got["b"].issues, got["b"].status) == ("missing_columns|no_valid_dates", "failed")
    assert (got["c"].issues, got["c"].duplicate_dates, got["c"].max_gap_seconds, got["c"].gap_count) == ("duplicate_dates|large_gaps|missing_columns", 2, 29 * 86400.0, 1)


def test_intervals(spark):
    day, minute = dt.datetime(2024, 1, 1), dt.timedelta(minutes=15)
    rows = [("two", day), ("two", day), *(("fine", day + minute * i) for i in range(20)), *(("daily", day + dt.timedelta(days=i)) for i in range(9)), ("same", day), ("same", day), ("same", day)]
    got = {r.symbol: r.passes for r in C.interval_check(spark.createDataFrame(rows, "symbol string, date timestamp"), 900).collect()}
    assert got == {"two": True, "fine": True, "daily": False, "same": True}


def test_review_queue(spark):
    targets = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), ("C", 4)], "symbol string, k int")
    got = {(r.symbol, r.k): (r.repair_method, r.repair_reason) for r in C.review_queue(targets, targets.where("symbol = 'B'"), spark.createDataFrame([("A", "odd")], "symbol string, reason string")).collect()}
    assert got == {("A", 1): ("manual_review_no_change", "odd"), ("A", 2): ("manual_review_no_change", "odd"), ("C", 4): ("unclassified_no_change", C.UNCLASSIFIED)}


def test_universe(spark):
    x = spark.createDataFrame([("2330", "A", "listed"), ("2330a", "A", None), ("23301", "A", "listed"), ("00878", "A", "listed"), ("1101", "x權證", "listed"), ("X1", "gone", "tw_Delisted")], "code string, name string, market string")
    assert sorted(r.code for r in U.supported_universe(x).collect()) == ["00878", "2330", "2330a", "X1"]
    okx = spark.createDataFrame([("BTC-USDT-SWAP", "live", "USDT"), ("ETH-USD-SWAP", "live", "USD"), ("OLD", "suspend", "USD"), (None, "live", "USD")], "inst_id string, state string, quote_ccy string")
    assert sorted(r.code for r in U.listed_instruments(okx).collect()) == ["BTCUSDTSWAP", "ETHUSDSWAP"]
    bybit = spark.createDataFrame([("BTCUSDT", "Trading", "LinearPerpetual"), ("X", "Closed", "LinearPerpetual"), ("Y", "Trading", "LinearFutures")], "symbol string, status string, contract_type string")
    assert [r.code for r in U.listed_instruments(bybit, "bybit").collect()] == ["BTCUSDT"]
    pairs = spark.createDataFrame([("EURUSD",), ("XXXUSD",)], "pair string")
    money = spark.createDataFrame([("EUR",), ("USD",)], "currency string")
    assert [r.pair for r in U.supported_pairs(pairs, money).collect()] == ["EURUSD"]
    coins = spark.createDataFrame([("btc", "Bitcoin", 1), ("btc", "other", 0), ("BTC", "x", 2), (" eth ", "", 3), ("x", "y", 4), ("toolongname", "y", 5), (None, "y", 6)], "symbol string, name string, ingest_seq long")
    assert sorted((r.code, r.name, r.ticker) for r in U.crypto_universe(coins).collect()) == [("BTCUSD", "other", "BTC-USD"), ("ETHUSD", "ETH", "ETH-USD")]
    fx = spark.createDataFrame([("A", "EURUSD=X"), ("B", "eurgbp=x, spot"), ("C", "EURUSD=X,USDEUR=X"), ("D", "EURUSD")], "code string, tickers string")
    got = {}
    for r in U.candidate_tickers(fx, fx=True).collect():
        got.setdefault(r.code, []).append(r.ticker)
    assert got == {"A": ["EURUSD=X", "USDEUR=X"], "B": ["eurgbp=x", "spot", "GBPEUR=X"], "C": ["EURUSD=X", "USDEUR=X"], "D": ["EURUSD"]}


def test_stream_merge_equals_batch(spark, tmp_path):
    d = dt.datetime(2024, 1, 30)
    rows = [("S", d + dt.timedelta(days=i % 4), float(i), i) for i in range(8)]
    df = spark.createDataFrame(rows, "symbol string, date timestamp, close double, ingest_seq long")
    src = str(tmp_path / "src")
    for k in range(2):
        df.where(F.col("ingest_seq") % 2 == k).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    ST.merge_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    got = {r.date: r.close for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {r.date: r.close for r in C.keep_last(df, ["symbol", "date"]).collect()}


def test_stream_bars_equal_batch(spark, tmp_path):
    rows = [("S", dt.datetime(2024, 1, 1, 0, m), m, float(m % 7), 1.0) for m in range(60)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, seq int, price double, size double")
    df.write.parquet(str(tmp_path / "ticks"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "ticks"))
    q = ST.interval_bars(stream, watermark="1 hour").writeStream.format("memory").queryName("bars15").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(spark.table("bars15").collect()) == sorted(ST.interval_bars(df).collect())


def test_carried_state_over_batches(spark, tmp_path):
    # the second segment begins within the second batch
    rows = [("r", i // 3, dt.date(2024, 1, 1 + i), s, float((i + k) % 3) / 4, 0.01) for i in range(6) for k, s in enumerate("AB")]
    df = spark.createDataFrame(rows, "run_id string, segment int, date date, symbol string, weight double, return_1d double")
    for k in range(3):
        df.where((F.dayofmonth("date") - 1) / 2 >= k).where((F.dayofmonth("date") - 1) / 2 < k + 1).coalesce(1).write.mode("append").parquet(str(tmp_path / "w"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(tmp_path / "w"))
    q = ST.carried_turnover(stream).writeStream.format("memory").queryName("turnover").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r.date: r.turnover for r in spark.table("turnover").collect()}
    from tidemark.operators.folds import segment_turnover

    want = {r.date: r.turnover for r in segment_turnover(df).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
