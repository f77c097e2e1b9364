"""Symbol universes: tickers, listings, lists and priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleaning import keep_first


# Codes of listed shares and funds, and marks of derivative names.
LISTED_CODE = r"^(?:[0-9]{4}[A-Z]?|00[0-9A-Z]{3,4})$"
DERIVATIVE_NAME = "(權證|牛證|熊證|元展|展延)"


def supported_universe(symbols: DataFrame, code: str = LISTED_CODE, excluded_name: str = DERIVATIVE_NAME) -> DataFrame:
    """Delisted symbols, whatever their code, and active ones with a listed code whose name is no derivative's.

    symbols: (code, name, market); a missing market is an active one.
    """
    market = F.col("market") if "market" in symbols.columns else F.lit(None).cast("string")
    delisted = F.coalesce(F.lower(market).contains("delisted"), F.lit(False))
    active = F.upper(F.trim("code")).rlike(code) & ~F.coalesce(F.trim("name").rlike(excluded_name), F.lit(False))
    return symbols.where(delisted | F.coalesce(active, F.lit(False)))


# An FX ticker, a coin's symbol, and the endings of archived codes.
FX_TICKER = r"^[A-Z]{6}=X$"
COIN_SYMBOL = "^[a-z]{2,8}$"
ARCHIVE_CODE = "_(?:DL|TW|TWO)$"


def candidate_tickers(symbols: DataFrame, fx: bool = False) -> DataFrame:
    """`symbols` once for each ticker of its comma-separated list, in order, with `ticker`; a list without any ticker is a ticker itself.

    With `fx`, the inverse of each ticker like EURUSD=X (in any case) follows
    the list, unless it is in it.
    """
    listed = F.filter(F.transform(F.split(F.trim("tickers"), ","), lambda t: F.trim(t)), lambda t: t != "")
    listed = F.when(F.size(listed) > 0, listed).otherwise(F.array(F.trim("tickers")))
    out = symbols.withColumn("_t", listed)
    if fx:
        pairs = F.filter(F.transform("_t", lambda t: F.upper(t)), lambda t: t.rlike(FX_TICKER))
        turned = F.transform(pairs, lambda t: F.concat(F.substring(t, 4, 3), F.substring(t, 1, 3), F.lit("=X")))
        out = out.withColumn("_t", F.concat("_t", F.array_except(turned, "_t")))
    return out.withColumn("ticker", F.explode("_t")).drop("_t")


def crypto_universe(coins: DataFrame) -> DataFrame:
    """(code, name, ticker) of coins (symbol, name, ingest_seq): lower-case symbols of 2 to 8 letters, the first of each, quoted in dollars."""
    symbol = F.trim("symbol")
    upper = F.upper(symbol)
    name = F.coalesce(F.nullif(F.trim("name"), F.lit("")), upper)
    out = coins.where(symbol.rlike(COIN_SYMBOL)).select(F.concat(upper, F.lit("USD")).alias("code"), name.alias("name"), F.concat(upper, F.lit("-USD")).alias("ticker"), "ingest_seq")
    return keep_first(out, ["code"]).drop("ingest_seq")


def new_symbols(wanted: DataFrame, known: DataFrame) -> DataFrame:
    return wanted.join(known.select("code").distinct(), "code", "left_anti")


def available_candidates(candidates: DataFrame, blacklist: DataFrame) -> DataFrame:
    return candidates.join(blacklist.select("ticker").distinct(), "ticker", "left_anti")


def all_blacklisted(candidates: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Codes none of whose candidate tickers is left."""
    marked = candidates.join(blacklist.select("ticker", F.lit(True).alias("b")).distinct(), "ticker", "left")
    return marked.groupBy("code").agg(F.bool_and(F.coalesce("b", F.lit(False))).alias("gone")).where("gone").select("code")


def apply_listing_state(symbols: DataFrame, active: DataFrame, delisted: DataFrame, market: str = "active", gone: str = "delisted") -> DataFrame:
    """`symbols` with the market that the day's lists give them.

    symbols: (code, tickers, market); active and delisted: (ticker).  A
    delisted symbol becomes `market` if one of its tickers is active and its
    code is no archive's; another one becomes `gone` if a ticker is delisted
    and none is active; all others, also those whose market is active
    already, keep what they have.  Keys meet in upper case.
    """
    t = candidate_tickers(symbols.select("code", "tickers")).select("code", F.upper("ticker").alias("ticker"))
    known = lambda x, n: x.select(F.upper(F.trim("ticker")).alias("ticker"), F.lit(True).alias(n)).distinct()
    flags = t.join(known(active, "_a"), "ticker", "left").join(known(delisted, "_d"), "ticker", "left").groupBy("code").agg(F.max("_a").alias("_a"), F.max("_d").alias("_d"))
    out = symbols.join(flags, "code", "left")
    was = F.coalesce(F.lower("market").contains("delisted"), F.lit(False))
    on, off = F.coalesce("_a", F.lit(False)), F.coalesce("_d", F.lit(False))
    revived = was & on & ~F.upper(F.trim("code")).rlike(ARCHIVE_CODE)
    return out.withColumn("market", F.when(revived, market).when(~was & off & ~on, gone).otherwise(F.col("market"))).drop("_a", "_d")


def supported_pairs(pairs: DataFrame, currencies: DataFrame) -> DataFrame:
    c = currencies.select("currency").distinct()
    both = pairs.withColumns({"base": F.substring("pair", 1, 3), "quote": F.substring("pair", 4, 3)})
    return both.join(c.withColumnRenamed("currency", "base"), "base", "left_semi").join(c.withColumnRenamed("currency", "quote"), "quote", "left_semi").drop("base", "quote")


# An exchange's generic code.
GENERIC_CODE = "^[0-9]{4,6}[A-Z]{0,2}$"


def symbol_record(raw: Column, asset: str, local: bool = False) -> Column:
    """struct(code, tickers) of a bare symbol or ticker of an asset class (`crypto`, `forex`, `tw` or another); null if there is none.

    Coins are quoted in dollars, pairs end in =X, and shares of the exchange
    in .TW (or as given); with `local` a generic code of the exchange has both
    of its endings, and none if its kind is not listed.
    """
    upper = F.nullif(F.upper(F.trim(raw)), F.lit(""))
    record = lambda code, tickers: F.struct(code.alias("code"), tickers.alias("tickers"))
    if asset == "crypto":
        coin = F.regexp_replace(upper, "-USD$", "")
        coin = F.when(upper.endswith("-USD"), coin).when(upper.endswith("USD") & (F.length(upper) > 3), F.regexp_replace(upper, "USD$", "")).otherwise(upper)
        out = record(F.concat(coin, F.lit("USD")), F.concat(coin, F.lit("-USD")))
    elif asset == "forex":
        pair = F.regexp_replace(upper, "=X$", "")
        out = record(pair, F.concat(pair, F.lit("=X")))
    elif asset == "tw":
        given = upper.rlike("[.]TWO?$")
        out = F.when(given, record(F.substring_index(upper, ".", 1), upper)).otherwise(record(upper, F.concat(upper, F.lit(".TW"))))
        if local:
            both = record(upper, F.concat(upper, F.lit(".TW,"), upper, F.lit(".TWO")))
            out = F.when(~upper.rlike(GENERIC_CODE), out).when(upper.rlike(LISTED_CODE), both)
    else:
        out = record(upper, upper)
    return F.when(upper.isNotNull(), out)


def tracked_symbols(local: DataFrame, manifest: DataFrame, whitelist: DataFrame, asset: str = "stock") -> DataFrame:
    """(code, name, market, tickers, origin) of the symbols with local files, and of the whitelist's that have none.

    local: (code); whitelist: (ticker); manifest: (code, name, market,
    tickers).  The manifest's record goes before one made from the code or
    ticker alone.  Pairs whose local files no manifest knows are left out, for
    they come from other sources.
    """
    known = manifest.select("code", F.col("name").alias("_name"), F.col("market").alias("_market"), F.col("tickers").alias("_tickers")).dropDuplicates(["code"])
    own = local.select(F.nullif(F.upper(F.trim("code")), F.lit("")).alias("code")).where("code is not null").distinct()
    own = own.join(known, "code", "left").withColumn("_r", symbol_record(F.col("code"), asset, local=True) if asset != "forex" else F.lit(None).cast("struct<code:string,tickers:string>"))
    own = own.where("_tickers is not null or _r is not null").withColumns({"origin": F.lit("local"), "code": F.when(F.col("_tickers").isNotNull(), F.col("code")).otherwise(F.col("_r.code"))})
    wanted = whitelist.select(symbol_record(F.col("ticker"), asset).alias("_r")).where("_r is not null")
    # of tickers of one code the first in their order
    wanted = wanted.groupBy(F.col("_r.code").alias("code")).agg(F.min("_r").alias("_r")).join(own.select("code").distinct(), "code", "left_anti")
    wanted = wanted.join(known, "code", "left").withColumn("origin", F.lit("whitelist"))
    out = own.unionByName(wanted)
    return out.select("code", F.coalesce("_name", "code").alias("name"), F.coalesce("_market", F.lit(asset)).alias("market"), F.coalesce("_tickers", F.col("_r.tickers")).alias("tickers"), "origin")


def prioritised_union(lists: list[DataFrame], limit: int | None = None) -> DataFrame:
    """Codes of several lists; the first list that has a code gives its row."""
    out = None
    for i, part in enumerate(lists):
        part = part.withColumn("priority", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    out = keep_first(out, ["code"], "priority")
    return out.orderBy("priority", "code").limit(limit) if limit else out


def update_symbol_list(current: DataFrame, add: DataFrame, clear: DataFrame) -> DataFrame:
    return current.select("code").union(add.select("code")).distinct().join(clear.select("code").distinct(), "code", "left_anti")


def listed_instruments(rows: DataFrame, venue: str = "okx") -> DataFrame:
    """Landed instrument records of perpetuals that trade, with their `code`.

    okx: (inst_id, state, ...), live ones; bybit: (symbol, status,
    contract_type, ...), perpetual contracts in trading.
    """
    if venue == "okx":
        return rows.where((F.col("state") == "live") & (F.col("inst_id") != "")).withColumn("code", F.replace("inst_id", F.lit("-"), F.lit("")))
    if venue == "bybit":
        return rows.where((F.col("status") == "Trading") & F.col("contract_type").contains("Perpetual") & (F.col("symbol") != "")).withColumn("code", F.col("symbol"))
    raise ValueError(f"unknown venue {venue}: okx or bybit")


def symbol_benchmark(panel: DataFrame, aliases: list[str]) -> DataFrame:
    """(date, benchmark_return) of the first alias that the panel has; raises if it has none."""
    names: Column = F.upper("symbol")
    have = {r["s"] for r in panel.where(names.isin(*[a.upper() for a in aliases])).select(names.alias("s")).distinct().collect()}
    chosen = next((a.upper() for a in aliases if a.upper() in have), None)
    if chosen is None:
        raise ValueError(f"no benchmark among {aliases}")
    return panel.where(names == chosen).select("date", F.col("return_1d").alias("benchmark_return"))
