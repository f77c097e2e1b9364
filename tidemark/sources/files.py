"""Landed files in, result tables out."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.operators.cleaning import keep_last

BARS = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("market", T.StringType()), T.StructField("date", T.TimestampNTZType())]
    + [T.StructField(c, T.DoubleType()) for c in ("open", "max", "min", "close", "adjclose", "Trading_Volume", "Dividends", "Stock Splits")]
    + [T.StructField("source", T.StringType()), T.StructField("ingest_seq", T.LongType())]
)


def scan_symbol_files(spark: SparkSession, root: str, suffix: str = "_features.parquet") -> DataFrame:
    """All `<symbol>_features.parquet` files of a folder, or folders of that name (also `column=<symbol>_features.parquet`).

    The symbol comes from the name of the file or of its folder.
    """
    rows = spark.read.option("mergeSchema", "true").parquet(f"{root.rstrip('/')}/*{suffix}")
    return rows.withColumn("symbol", F.regexp_extract(F.col("_metadata.file_path"), "([^/=]*)" + suffix.replace(".", r"\.") + "(?:/[^/]*)?$", 1))


def source_fingerprint(spark: SparkSession, root: str, options: str = "") -> DataFrame:
    """One row (version, options, fingerprint) over name, size and time of all files; only metadata are read."""
    files = spark.read.option("mergeSchema", "true").parquet(root).select("_metadata.file_name", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    each = F.xxhash64("file_name", "file_size", "file_modification_time").cast("decimal(38,0)")
    return files.agg(F.lit(1).alias("version"), F.lit(options).alias("options"), F.sha2(F.concat_ws(":", F.count("*"), F.sum(each)), 256).alias("fingerprint"))


def panel_snapshot(spark: SparkSession, root: str, saved: str, options: str, build) -> tuple[DataFrame, bool]:
    """The saved panel if version, options and fingerprint still match, else a rebuilt one; and whether it was reused."""
    now = source_fingerprint(spark, root, options)
    try:
        meta = spark.read.parquet(f"{saved}/meta")
        if meta.join(now, ["version", "options", "fingerprint"]).count():
            return spark.read.parquet(f"{saved}/panel"), True
    except Exception as error:  # nothing saved yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
    build().write.mode("overwrite").parquet(f"{saved}/panel")
    now.write.mode("overwrite").parquet(f"{saved}/meta")
    return spark.read.parquet(f"{saved}/panel"), False


def read_symbol_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", "true").csv(path).where("code is not null and trim(code) != ''")


def read_symbol_list(spark: SparkSession, path: str) -> DataFrame:
    """One code per line; blank lines and comments are skipped."""
    return spark.read.text(path).select(F.trim("value").alias("code")).where("code != '' and not startswith(code, '#')").distinct()


def read_listing_directory(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated listing: no test issues, no trailer line, valid tickers, each once."""
    rows = spark.read.option("sep", "|").option("header", "true").csv(path)
    test = F.coalesce(F.col("Test Issue") == "Y", F.lit(False)) if "Test Issue" in rows.columns else F.lit(False)
    return rows.where(~test & F.col("Symbol").rlike(r"^[A-Z][A-Z.\-]{0,9}$")).select(F.col("Symbol").alias("ticker"), F.col("Security Name").alias("name")).dropDuplicates(["ticker"])


def parse_candle_payload(landed: DataFrame, payload: str, least: int) -> DataFrame:
    """`landed` with `c`, one row per candle of the JSON array; candles shorter than `least` fields go."""
    rows = landed.withColumn("c", F.explode(F.from_json(payload, "array<array<string>>")))
    return rows.where(F.size("c") >= least)


def _number(i: int):
    return F.element_at("c", i + 1).try_cast("double")


def _bars(rows: DataFrame, volume) -> DataFrame:
    out = rows.select(
        "symbol", F.timestamp_millis(F.element_at("c", 1).try_cast("long")).cast("timestamp_ntz").alias("date"), _number(1).alias("open"), _number(2).alias("max"), _number(3).alias("min"), _number(4).alias("close"), _number(4).alias("adjclose"), volume.alias("Trading_Volume"), "ingest_seq"
    )
    return keep_last(out.where("date is not null and close is not null"), ["symbol", "date"])


def normalize_okx_candles(landed: DataFrame, payload: str = "payload") -> DataFrame:
    """Daily contract candles of nine fields; volume in the quote currency if it is given, else in contracts.

    The last candle of a day stays, by its time and then by ingest order.
    """
    rows = parse_candle_payload(landed, payload, 9)
    text = lambda i: F.nullif(F.element_at("c", i + 1), F.lit(""))
    number = lambda i: F.coalesce(text(i).try_cast("double"), F.lit(0.0))
    ms = F.element_at("c", 1).try_cast("long")
    out = rows.select(
        "symbol", F.to_date(F.timestamp_millis(ms).cast("timestamp_ntz")).alias("date"), _number(1).alias("open"), _number(2).alias("max"), _number(3).alias("min"), _number(4).alias("close"), _number(4).alias("adjclose"),
        F.coalesce(text(7), text(5)).try_cast("double").alias("Trading_Volume"), number(5).alias("okx_volume_contract"), number(6).alias("okx_volume_base"), number(7).alias("okx_volume_quote"), F.coalesce(text(8).try_cast("int"), F.lit(0)).alias("okx_confirm"),
        "ingest_seq", F.struct(ms.alias("ms"), "ingest_seq").alias("_order"),
    )
    return keep_last(out.where("date is not null and close is not null"), ["symbol", "date"], "_order").drop("_order")


def normalize_bybit_candles(landed: DataFrame, payload: str = "payload") -> DataFrame:
    """Candles of seven fields; an empty volume is zero."""
    return _bars(parse_candle_payload(landed, payload, 7), F.coalesce(_number(5), F.lit(0.0)))


def parse_rate_payload(landed: DataFrame, payload: str = "payload") -> DataFrame:
    """(day, currency, rate) of a JSON object {day: {currency: rate}}."""
    days = landed.select("ingest_seq", F.explode(F.from_json(payload, "map<string,map<string,double>>")).alias("day", "rates"))
    return days.select("ingest_seq", F.col("day").try_cast("date").alias("day"), F.explode("rates").alias("currency", "rate")).where("day is not null and rate is not null")


def rates_to_bars(rates: DataFrame, base: str, first: str, last: str) -> DataFrame:
    """One flat bar per day and pair, both days included; FX fixings have no volume."""
    part = rates.where(F.col("day").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
    r = F.col("rate")
    out = part.select(F.concat(F.lit(base), F.col("currency")).alias("symbol"), F.col("day").alias("date"), *(r.alias(c) for c in ("open", "max", "min", "close", "adjclose")), F.lit(None).cast("double").alias("Trading_Volume"), "ingest_seq")
    return keep_last(out, ["symbol", "date"])


def write_bars(bars: DataFrame, path: str) -> None:
    """Replaces the markets that `bars` holds, and no others; each market's folder is swapped at commit."""
    bars.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("market").parquet(path)


def write_table(table: DataFrame, path: str, fmt: str) -> None:
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format {fmt}: csv or parquet")
    writer = table.write.mode("overwrite")
    writer.option("header", "true").csv(path) if fmt == "csv" else writer.option("compression", "snappy").parquet(path)


def nested_as_text(table: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return table.select(*(F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in table.schema))


def export_nested_csv(table: DataFrame, path: str) -> None:
    """CSV of any table; an empty one still gets its header."""
    flat = nested_as_text(table)
    (flat.coalesce(1) if flat.isEmpty() else flat).write.mode("overwrite").option("header", "true").csv(path)


def write_summary(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").json(path)


def write_report(table: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    table.select(*columns).orderBy(*order).write.mode("overwrite").option("header", "true").csv(path)


#: Kinds of curve files in order of preference, with the names they go by.
FORMATS = {"parquet": "*.parquet", "jsonl": "*.json*", "csv": "*.csv"}


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as file metadata name it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString().rstrip("/")


def read_epoch_curves(spark: SparkSession, root: str) -> DataFrame:
    """(run, epoch, ...) of all curve files: one file per run, the newest, Parquet before JSON before CSV on ties.

    A run is a folder with files named epoch_curve, or as Spark names its
    parts; a file of another name is a run of its own.  Runs are named by
    their path below `root`, without the ending.  A missing number is null; an
    epoch is required.
    """
    parts = []
    base = len(_qualified(spark, root)) + 2
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    for rank, (fmt, names) in enumerate(FORMATS.items()):
        reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", names)
        try:
            rows = reader.parquet(root) if fmt == "parquet" else reader.json(root) if fmt == "jsonl" else reader.option("header", "true").option("inferSchema", "true").csv(root)
        except Exception as error:
            if "UNABLE_TO_INFER_SCHEMA" in str(error) or "PATH_NOT_FOUND" in str(error):
                continue
            raise
        if "epoch" not in rows.columns:
            continue
        numbers = [c for c, t in rows.dtypes if t in ("double", "float")]
        rows = rows.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in numbers})
        run = F.regexp_replace(F.substring(path, base, 1 << 20), r"(^|/)(epoch_curve|part-[^/]*)\.[^/]*$|\.[a-z]+$", "")
        # a part of a folder that is itself named epoch_curve.<ending>
        run = F.regexp_replace(run, r"(^|/)epoch_curve\.[a-z]+$", "")
        parts.append(rows.select("*", run.alias("run"), F.col("_metadata.file_modification_time").alias("_time"), F.lit(rank).alias("_rank")))
    if not parts:
        raise ValueError("no curve file with a column epoch")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    best = Window.partitionBy("run").orderBy(F.desc("_time"), "_rank")
    return out.withColumn("_best", F.dense_rank().over(best)).where("_best = 1").drop("_time", "_rank", "_best")


FACTS = "symbol string, columns array<string>, first_date date, last_date date, error string, checked_through string"


def file_facts(spark: SparkSession, root: str, suffix: str = "_features.parquet", checked_key: str = "checked_through") -> DataFrame:
    """(symbol, columns, first_date, last_date, error, checked_through) of every symbol's files, from what is on disk.

    error is null for a file with dates; else `empty` (no column date),
    `no_valid_date`, or `schema_error: ...` or `read_error: ...` with the
    reason why it can't be read.  checked_through is the footer's entry of
    `checked_key`, or that of the column date.  Files are opened in the tasks,
    one at a time, and only their footer and their dates are decoded.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    symbol = F.regexp_extract("path", "([^/=]*)" + suffix.replace(".", r"\.") + "(?:/[^/]*)?$", 1)
    files = files.select(symbol.alias("symbol"), "content").where("symbol != ''")

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(name.as_py(), *_facts(content.as_buffer(), checked_key)) for name, content in zip(batch.column(0), batch.column(1), strict=True)]
            kinds = [pa.string(), pa.list_(pa.string()), pa.date32(), pa.date32(), pa.string(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(columns, names=["symbol", "columns", "first_date", "last_date", "error", "checked_through"])

    each = files.mapInArrow(facts, FACTS)
    # a symbol may be a folder of parts: its dates are theirs, and what can't be read decides
    unread = F.max(F.when(F.col("error").contains("_error"), F.col("error")))
    out = each.groupBy("symbol").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("columns")))).alias("columns"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), unread.alias("unread"), F.max("error").alias("other"), F.max("checked_through").alias("checked_through")
    )
    return out.select("symbol", "columns", "first_date", "last_date", F.coalesce("unread", F.when(F.col("last_date").isNull(), F.col("other"))).alias("error"), "checked_through")


def _facts(content: pa.Buffer, checked_key: str) -> tuple:
    """(columns, first date, last date, error, checked_through) of one Parquet file."""
    try:
        file = pq.ParquetFile(pa.BufferReader(content))
        names = file.schema_arrow.names
        footer = {k.decode(): v.decode() for k, v in (file.metadata.metadata or {}).items()}
        checked = footer.get(checked_key)
        for field in json.loads(footer.get("org.apache.spark.sql.parquet.row.metadata", '{"fields": []}'))["fields"]:
            if field["name"] == "date":
                checked = checked or field["metadata"].get(checked_key)
    except Exception as error:  # whatever is wrong with the file is its fact
        return [], None, None, f"schema_error: {type(error).__name__}", None
    if "date" not in names:
        return names, None, None, "empty", checked
    try:
        dates = file.read(columns=["date"]).column("date")
        dates = pd.to_datetime(dates.to_pandas(), errors="coerce").dropna()
    except Exception as error:
        return names, None, None, f"read_error: {type(error).__name__}", checked
    if dates.empty:
        return names, None, None, "no_valid_date", checked
    return names, dates.min().date(), dates.max().date(), None, checked


def wide_weights(weights: DataFrame, symbols: list[str]) -> DataFrame:
    """One row per date and a column per symbol; the symbols are given, so no pass is needed to find them."""
    return weights.groupBy("date").pivot("symbol", symbols).agg(F.first("weight"))


def matrix(edges: DataFrame, metric: str, targets: list[str]) -> DataFrame:
    return edges.groupBy("source").pivot("target", targets).agg(F.sum(metric))
