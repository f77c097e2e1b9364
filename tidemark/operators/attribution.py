"""Attribution tables, folds of them, model fits and perturbations."""

from __future__ import annotations

import functools

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def attribution_table(methods: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of methods' (keys, share), missing shares as 0, and their mean."""
    parts = [df.select(*keys, F.col("share").alias(name)) for name, df in methods.items()]
    out = functools.reduce(lambda a, b: a.join(b, keys, "full"), parts).fillna(0.0, list(methods))
    return out.withColumn("mean_share", sum(F.col(n) for n in methods) / len(methods))


def shares(table: DataFrame, by: str, value: str = "value") -> DataFrame:
    """Sum per key and its share of the total; 0 if the total is 0."""
    sums = table.groupBy(by).agg(F.sum(value).alias("value"))
    total = sums.agg(F.sum("value").alias("t"))
    return sums.crossJoin(F.broadcast(total)).withColumn("share", F.coalesce(F.col("value") / F.nullif("t", F.lit(0.0)), F.lit(0.0))).drop("t")  # one row


def combine_chunks(chunks: DataFrame, keys: list[str], metrics: list[str], rows: str = "rows") -> DataFrame:
    return chunks.groupBy(*keys).agg(*((F.sum(F.col(m) * F.col(rows)) / F.sum(rows)).alias(m) for m in metrics), F.sum(rows).alias(rows))


def fold_stability(table: DataFrame) -> DataFrame:
    """Folds present, mean and spread of rank and share of each feature; table: (fold_id, feature, share)."""
    ranked = table.withColumn("rank", F.rank().over(Window.partitionBy("fold_id").orderBy(F.desc("share"))))
    return ranked.groupBy("feature").agg(F.count_distinct("fold_id").alias("folds"), F.avg("rank").alias("mean_rank"), F.stddev_samp("rank").alias("std_rank"), F.avg("share").alias("mean_share"), F.stddev_samp("share").alias("std_share"))


def top_groups_by_sum(table: DataFrame, by: str, value: str, n: int) -> DataFrame:
    return table.groupBy(by).agg(F.sum(value).alias("total")).orderBy(F.desc("total"), by).limit(n)


def top_cells(table: DataFrame, row: str, column: str, value: str, n: int) -> DataFrame:
    """The n cells of the largest absolute sum; ties by row and column."""
    cells = table.groupBy(row, column).agg(F.sum(value).alias("total"))
    return cells.orderBy(F.desc(F.abs("total")), row, column).limit(n)


def feature_correlation(panel: DataFrame, names: list[str], targets: list[str]) -> DataFrame:
    """(feature, target, correlation), all pairs in one pass; 0 below three rows or without variance."""
    sums = []
    for f in names:
        for t in targets:
            ok = F.col(f).isNotNull() & F.col(t).isNotNull()
            x, y = F.when(ok, F.col(f)), F.when(ok, F.col(t))
            fine = (F.count(x) >= 3) & (F.stddev_pop(x) > 0) & (F.stddev_pop(y) > 0)
            sums.append(F.when(fine, F.corr(x, y)).otherwise(0.0).alias(f"{f}|{t}"))
    one = panel.agg(*sums)
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.lit(t).alias("target"), F.col(f"`{f}|{t}`").alias("correlation")) for f in names for t in targets))
    return one.select(F.inline(pairs))


def aux_summary(rows: DataFrame, vector: str) -> DataFrame:
    """Figures of a vector column over all its elements."""
    x = rows.select(F.explode(vector).alias("x")).select(F.col("x").cast("double").alias("x"))
    fine = F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") != float("inf"))
    v = F.when(fine, F.col("x"))
    return x.agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.avg(F.abs(v)).alias("mean_abs"), F.max(F.abs(v)).alias("max_abs"), F.avg((F.abs(v) < 1e-8).cast("double")).alias("zero_share"), F.avg(fine.cast("double")).alias("finite_share"))


def aux_dimensions(rows: DataFrame, vector: str) -> DataFrame:
    x = rows.select(F.posexplode(vector).alias("dimension", "x")).groupBy("dimension").agg(F.avg(F.abs(F.col("x").cast("double"))).alias("value"))
    return shares(x, "dimension").withColumnRenamed("value", "mean_abs")


# Rules and thresholds.
STABILITY_RULES = {"untradable_weight": 1e-5, "max_weight": 0.35, "turnover": 1.5, "top_feature_share": 0.55, "top_lookback_share": 0.70, "correlation": 0.75, "zero_fraction": 0.95}
#: What a warning says; net exposure is warned of without a rule row.
WARNINGS = {
    "untradable_weight": "weight lies on symbols that cannot be traded", "net_exposure": "mean absolute net exposure is high", "max_weight": "one symbol holds much of a day's weight", "turnover": "turnover is high, positions may flip daily",
    "top_feature_share": "one feature dominates the attribution", "top_lookback_share": "one lookback day dominates the attribution", "correlation": "a feature and a score or weight are strongly correlated", "zero_fraction": "auxiliary outputs are close to zero",
}
NET_EXPOSURE = 0.25


def stability_flags(metrics: DataFrame) -> DataFrame:
    """(rule, value, threshold, status) for the columns of a one-row table of metrics; a missing value passes."""
    have = [(n, t) for n, t in STABILITY_RULES.items() if n in metrics.columns]
    warn = lambda n, t: F.when(F.coalesce(F.abs(F.col(n)) > t, F.lit(False)), "warn").otherwise("pass")
    rows = F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).cast("double").alias("value"), F.lit(t).alias("threshold"), warn(n, t).alias("status")) for n, t in have))
    return metrics.select(F.inline(rows))


def stability_warnings(metrics: DataFrame) -> DataFrame:
    """(place, warning) of a one-row table of metrics: what its flags warn of, in the order of the rules, or that nothing was found."""
    thresholds = {"untradable_weight": STABILITY_RULES["untradable_weight"], "net_exposure": NET_EXPOSURE, **STABILITY_RULES}
    said = [F.when(F.abs(F.col(n)) > thresholds[n], F.lit(text)) for n, text in WARNINGS.items() if n in metrics.columns]
    found = F.filter(F.array(*said), lambda w: w.isNotNull()) if said else F.array().cast("array<string>")
    none = F.array(F.lit("no rule of thumb was broken; look at the tables all the same"))
    return metrics.select(F.posexplode(F.when(F.size(found) > 0, found).otherwise(none)).alias("place", "warning"))


def sample_dates(panel: DataFrame, how: str, n: int) -> DataFrame:
    """Rows of n dates: the first, the last, or evenly spread ones, from the first to the last; all dates if there are no more."""
    dates = panel.select("date").distinct()
    if how in ("first", "last"):
        chosen = dates.orderBy(F.asc("date") if how == "first" else F.desc("date")).limit(n)
    else:
        # one row per date
        ranked = dates.withColumn("i", F.row_number().over(Window.orderBy("date")) - 1).withColumn("c", F.count("*").over(Window.partitionBy()))
        # the k-th of n places is k (c - 1) / (n - 1), rounded down; date i is one if a k between i and i + 1 exists
        k = F.ceil(F.col("i") * (n - 1) / F.greatest(F.col("c") - 1, F.lit(1)))
        place = F.floor(k * (F.col("c") - 1) / F.lit(max(n - 1, 1)))
        chosen = ranked.where((F.col("c") <= n) | (F.col("i") == 0) | (F.lit(n > 1) & (k <= n - 1) & (place == F.col("i")))).select("date")
    return panel.join(chosen, "date", "left_semi")


def sample_epochs(curves: DataFrame, k: int) -> DataFrame:
    """Every k-th epoch and the last, each once per run."""
    run = Window.partitionBy("run")
    rows = curves.withColumn("_l", F.max("epoch").over(run)).where((F.col("epoch") % k == 0) | (F.col("epoch") == F.col("_l"))).drop("_l")
    return rows.dropDuplicates(["run", "epoch"])


def no_improve_epochs(curves: DataFrame, loss: str = "val_mean", counter: str | None = None) -> DataFrame:
    """(run, no_improve): epochs since the running best loss fell, as a resumed run counts them.

    An epoch with a counter sets the count to it, and the ones after go on
    from there.  Epochs without counter and finite loss are skipped, and so
    are epochs below 1.  A run without any other epoch has 0.
    """
    order = Window.partitionBy("run").orderBy("epoch")
    given = F.col(counter).cast("long") if counter else F.lit(None).cast("long")
    value = F.col(loss).cast("double")
    value = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
    x = curves.select("run", "epoch", value.alias("v"), F.when(given >= 0, given).alias("g"))
    used = x.where((F.col("epoch") > 0) & (F.col("v").isNotNull() | F.col("g").isNotNull()))
    best = F.min("v").over(order.rowsBetween(Window.unboundedPreceding, -1))
    used = used.withColumns({"i": F.row_number().over(order), "set": F.coalesce("g", F.when(F.col("v") < F.coalesce(best, F.lit(float("inf"))), 0))})
    out = used.groupBy("run").agg(F.max("i").alias("n"), F.max(F.when(F.col("set").isNotNull(), F.col("i"))).alias("at"), F.max_by("set", F.when(F.col("set").isNotNull(), F.col("i"))).alias("set"))
    return curves.select("run").distinct().join(out, "run", "left").select("run", F.coalesce(F.col("set") + F.col("n") - F.col("at"), F.lit(0)).cast("long").alias("no_improve"))


def select_symbols(weights: DataFrame, n: int) -> DataFrame:
    """The n symbols, ever tradable, of the largest mean |weight| + 0.05 mean |score|."""
    x = weights.groupBy("symbol").agg((F.avg(F.abs("weight")) + 0.05 * F.avg(F.abs("score"))).alias("value"), F.bool_or("tradable").alias("ever"))
    return x.where("ever").orderBy(F.desc("value"), "symbol").limit(n).select("symbol", "value")


def training_matrix(lagged: DataFrame, names: list[str]) -> DataFrame:
    """(date, symbol, features, label) of the tradable rows with a label."""
    rows = lagged.where(F.col("tradable") & F.col("return_1d").isNotNull()).withColumn("label", F.col("return_1d"))
    return VectorAssembler(inputCols=names, outputCol="features").transform(rows.fillna(0.0, names))


def ridge(matrix: DataFrame, alpha: float = 1.0):
    """Least squares with alpha |b|^2, as the sum-of-squares form has it."""
    n, spread = matrix.agg(F.count("*"), F.stddev_pop("label")).first()
    return LinearRegression(regParam=alpha * spread / n, elasticNetParam=0.0, standardization=False, solver="normal").fit(matrix)


def elastic_net(matrix: DataFrame, alpha: float = 1e-4, l1_ratio: float = 0.5):
    """1/2n |y - Xb|^2 + alpha (l1 |b|_1 + (1 - l1)/2 |b|^2); the squared part is divided by the label's spread."""
    spread = matrix.agg(F.stddev_pop("label")).first()[0]
    one, two = alpha * l1_ratio, alpha * (1 - l1_ratio) * spread
    return LinearRegression(regParam=one + two, elasticNetParam=one / (one + two), standardization=False, maxIter=500, tol=1e-10).fit(matrix)


def boosted_trees(matrix: DataFrame, rounds: int = 20, depth: int = 4, seed: int = 7):
    return GBTRegressor(maxIter=rounds, maxDepth=depth, seed=seed).fit(matrix)


def score_panel(model, matrix: DataFrame) -> DataFrame:
    return model.transform(matrix).withColumnRenamed("prediction", "score")


def zero_feature_importance(model, rows: DataFrame, names: list[str]) -> DataFrame:
    """(feature, importance): mean absolute change of the score if one feature is set to zero.

    The list of features is a literal array, so rows multiply within their
    task and nothing is shuffled before the final sums.
    """
    base = model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(rows)).select(*names, F.col("prediction").alias("base"))
    each = base.withColumn("feature", F.explode(F.array(*map(F.lit, names))))
    each = each.withColumns({n: F.when(F.col("feature") == n, F.lit(0.0)).otherwise(F.col(n)) for n in names})
    scored = model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(each))
    return scored.groupBy("feature").agg(F.avg(F.abs(F.col("prediction") - F.col("base"))).alias("importance"))


# Marks of the features that a named shock touches; `zero` touches all.
SHOCKS = {
    "momentum": ("logret", "return", "ret"),
    "gap": ("open", "gap", "max", "min"),
    "volume": ("volume", "vol"),
    "volatility": ("max", "min", "shadow", "range", "clv"),
    "liquidity": ("volume", "turnover", "amount", "liquid"),
}


def shocked_features(names: list[str], shock: str) -> list[str]:
    """Features whose lower-case name holds one of the shock's marks; an unknown shock is its own mark."""
    shock = shock.strip().lower()
    return list(names) if shock == "zero" else [n for n in names if any(m in n.lower() for m in SHOCKS.get(shock, (shock,)))]


def shocked_rows(rows: DataFrame, names: list[str], sources: list[str], shocks: list[str], scale: float = 1.0) -> DataFrame:
    """(shock, source, ...): `rows` of all symbols for each shock of each source, with the source's own features moved.

    A shock adds `scale` standard deviations, `liquidity` takes them away, and
    `zero` sets the features to zero.  All symbols are kept, since a score may
    depend on the whole day; sources and shocks are short lists.
    """
    spread = rows.agg(*(F.coalesce(F.stddev_pop(n), F.lit(0.0)).alias(f"sd_{n}") for n in names))
    x = rows.crossJoin(F.broadcast(spread))  # one row
    x = x.withColumn("source", F.explode(F.array(*map(F.lit, sources)))).withColumn("shock", F.explode(F.array(*map(F.lit, shocks))))

    def moved(n: str) -> Column:
        own = F.col("symbol") == F.col("source")
        out = F.when(F.lit(False), F.lit(0.0))
        for s in shocks:
            if n in shocked_features(names, s):
                kind = s.strip().lower()
                value = F.lit(0.0) if kind == "zero" else F.col(n) + (-scale if kind == "liquidity" else scale) * F.col(f"sd_{n}")
                out = out.when(own & (F.col("shock") == s), value)
        return out.otherwise(F.col(n))

    return x.withColumns({n: moved(n) for n in names}).drop(*(f"sd_{n}" for n in names))


def with_day_means(rows: DataFrame, names: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """`rows` with `mean_<name>`, the day's mean of each feature: how one symbol's features reach all scores of a day."""
    day = Window.partitionBy(*by, "date")
    return rows.withColumns({f"mean_{n}": F.avg(n).over(day) for n in names})


def day_zscore(value: str, *by: str) -> Column:
    """Standard score within a day; zero where the day has no spread."""
    day = Window.partitionBy(*by, "date")
    return F.coalesce((F.col(value) - F.avg(value).over(day)) / F.nullif(F.stddev_pop(value).over(day), F.lit(0.0)), F.lit(0.0))


def shock_scores(model, rows: DataFrame, names: list[str], sources: list[str], shocks: list[str], scale: float = 1.0) -> DataFrame:
    """Scores of a model on `names` and their day means, with the shocked features of one source moved, for each source and shock."""
    moved = with_day_means(shocked_rows(rows, names, sources, shocks, scale), names, ("shock", "source"))
    inputs = [*names, *(f"mean_{n}" for n in names)]
    return model.transform(VectorAssembler(inputCols=inputs, outputCol="features").transform(moved)).withColumnRenamed("prediction", "score")


def pca_2d(rows: DataFrame, vector: str) -> DataFrame:
    """`rows` with the first two principal coordinates and the vector's norm."""
    x = rows.withColumn("_v", array_to_vector(F.transform(vector, lambda v: v.cast("double"))))
    out = PCA(k=2, inputCol="_v", outputCol="_p").fit(x).transform(x).withColumn("_p", vector_to_array("_p"))
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))
    return out.withColumns({"pc1": F.col("_p")[0], "pc2": F.col("_p")[1], "norm": norm}).drop("_v", "_p")


def surrogate_ridge(rows: DataFrame, names: list[str], target: str, penalty: float = 1e-3) -> DataFrame:
    """(feature, coefficient, mean_abs_contribution, r2) of a ridge fit on standardised features."""
    stats = rows.agg(*(F.avg(n).alias(f"m_{n}") for n in names), *(F.stddev_pop(n).alias(f"s_{n}") for n in names))
    x = rows.crossJoin(F.broadcast(stats))  # one row
    x = x.select(F.col(target).alias("label"), *(F.coalesce((F.col(n) - F.col(f"m_{n}")) / F.nullif(f"s_{n}", F.lit(0.0)), F.lit(0.0)).alias(n) for n in names))
    model = ridge(VectorAssembler(inputCols=names, outputCol="features").transform(x), penalty)
    coef = model.coefficients.toArray()
    means = x.agg(*(F.avg(F.abs(F.col(n) * float(b))).alias(n) for n, b in zip(names, coef, strict=True)))
    r2 = float(model.summary.r2)
    return means.select(F.inline(F.array(*(F.struct(F.lit(n).alias("feature"), F.lit(float(b)).alias("coefficient"), F.col(n).alias("mean_abs_contribution"), F.lit(r2).alias("r2")) for n, b in zip(names, coef, strict=True)))))
