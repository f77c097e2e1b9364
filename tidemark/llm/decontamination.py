"""Benchmark decontamination by size-partitioned MinHash containment search.

An item lies inside a document if at least `threshold` of its five-word
shingles occur there.  Symmetric signatures cannot see a short item in a long
text, so the search samples the item alone: under each of several hash
functions the item's least shingle is kept, and that shingle occurs in a
document with a probability equal to the containment.  Items are partitioned
by size; a partition's number of hash functions brings the chance to miss an
item at the threshold below `miss`, or takes all shingles of small items.
Documents probe with all their shingles, a document too small for the item is
skipped, and every candidate is verified by exact containment.  An item of
fewer than five words is a size of its own: its whole sequence is its one
shingle, and documents also probe with runs of that many words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import KeyFilter, written
from tidemark.llm.license_scan import BREAKS

WIDTH = 5
THRESHOLD = 0.8
MISS = 1e-9
#: Up to so many sampled shingles (16 bytes each) are broadcast; more are joined by a shuffle of what a filter lets pass.
BROADCAST_ROWS = 1 << 20


def word_list(text: Column) -> Column:
    """The words of a text: runs of letters, digits and non-ASCII characters, lower-cased; a text without any has one empty word."""
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), BREAKS, " ")), " ")


def runs(words: Column, width: int) -> Column:
    """64-bit hashes of all runs of `width` words, in order; none if there are fewer words."""
    places = F.when((F.size(words) >= width) & (words[0] != ""), F.sequence(F.lit(1), F.greatest(F.size(words) - width + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.slice(words, i, width)))


def shingles(text: Column, widths: list[int]) -> Column:
    """The hashes of the runs of each of `widths` words, with the words found once."""
    return F.transform(F.array(word_list(text)), lambda words: F.concat(*(runs(words, w) for w in widths)))[0]


def sampled(items: DataFrame, threshold: float, miss: float) -> DataFrame:
    """(shingle, item, size): the least shingles of each item; items: (item, set, size)."""
    functions = math.ceil(math.log(miss) / math.log(1 - threshold))
    # partition by size: 2^k to 2^(k+1) - 1 shingles; small items are taken whole
    part = F.floor(F.log2(F.col("size").cast("double")))
    small = F.pow(F.lit(2.0), part + 1) - 1 <= functions
    least = F.transform(F.sequence(F.lit(1), F.lit(functions)), lambda j: F.array_min(F.transform("set", lambda h: F.struct(F.xxhash64(h, j), h.alias("h"))))["h"])
    kept = F.when(small, F.col("set")).otherwise(F.array_distinct(least))
    return items.select(F.explode(kept).alias("shingle"), "item", "size")


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, miss: float = MISS) -> DataFrame:
    """(doc_id, item_id, n_item, n_contained, containment) of each document row and item it contains.

    Words are runs of letters, digits and non-ASCII characters, lower-cased.
    An item of fewer than `width` words is contained where its words stand in
    order, and counts as one shingle.  Null texts contain nothing; null items
    and those without words are contained nowhere.  An item_id that stands for
    several texts is searched for each of them.  A repeated document row gives
    repeated rows, and a row without id is searched like any other.  Other
    columns are ignored.
    """
    return _found(docs, benchmark, threshold, width, miss).drop("tidemark_key")


def _found(docs: DataFrame, benchmark: DataFrame, threshold: float, width: int, miss: float, least_words: int = 1) -> DataFrame:
    """`contaminated` with `tidemark_key`, the hash of the row's text: ids may be null or stand for several texts."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("tidemark_key"))
    words = F.col("words")
    own = F.when(F.size(words) >= width, F.array_distinct(runs(words, width))).otherwise(F.array(F.xxhash64(words)))
    items = benchmark.select("item_id", word_list(F.col("text")).alias("words")).where((words[0] != "") & (F.size(words) >= least_words))
    items = items.select("item_id", F.least(F.size(words), F.lit(width)).alias("width"), own.alias("set"))
    items = items.select(F.struct("item_id", F.xxhash64("set").alias("text")).alias("item"), "width", "set", F.size("set").alias("size")).dropDuplicates(["item"])
    items = written(items)
    # at most `width` values
    widths = sorted(r[0] for r in items.select("width").distinct().collect()) or [width]
    sample = sampled(items, threshold, miss)
    rows = sample.count()
    probes = docs.select("tidemark_key", shingles(F.col("text"), widths).alias("s"))
    probes = probes.select("tidemark_key", F.size("s").alias("n"), F.explode("s").alias("shingle"))
    if rows <= BROADCAST_ROWS:
        met = probes.join(F.broadcast(sample), "shingle")
    else:
        # the few shingles that may be sampled ones are all that is shuffled
        met = KeyFilter(sample, "shingle").passing(probes, "shingle").join(sample, "shingle")
    met = met.where(F.col("n") >= F.ceil(F.col("size") * threshold - 1e-9))
    candidates = written(met.groupBy("tidemark_key", "item").agg(F.count("*").alias("hits")))
    sides = written(candidates.select("tidemark_key", "item").join(items, "item"))
    # only texts that may be candidates leave their place
    pairs = KeyFilter(candidates, "tidemark_key").passing(docs, "tidemark_key").join(sides, "tidemark_key")
    # runs of different widths have different hashes, so one intersection serves all widths
    inside = F.size(F.array_intersect(shingles(F.col("text"), widths), "set")).cast("long")
    exact = pairs.select("doc_id", "tidemark_key", F.col("item.item_id").alias("item_id"), F.col("size").cast("long").alias("n_item"), inside.alias("n_contained"))
    exact = exact.withColumn("containment", F.col("n_contained") / F.col("n_item").cast("double"))
    return exact.where(F.col("n_contained") >= F.ceil(F.col("n_item") * threshold - 1e-9))


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least_words: int = WIDTH) -> DataFrame:
    """`docs` without the rows that contain a benchmark item of at least `least_words` words.

    Shorter items are words that clean texts use as well; `contaminated` finds
    them, and a smaller `least_words` drops their documents too.  Rows are
    told apart by id and text, and a row without id goes like any other: an id
    that stands for two texts loses only the one that leaks, and repeated rows
    go or stay together.  Extra columns are kept, and an empty table stays
    empty.  Names
    that begin with tidemark_ are the operator's own.
    """
    found = written(_found(docs, benchmark, threshold, WIDTH, MISS, least_words).select(F.col("doc_id").alias("tidemark_id"), F.col("tidemark_key").alias("tidemark_found")).distinct())
    rows = KeyFilter(found, "tidemark_found").marked(docs.withColumn("tidemark_key", F.xxhash64("text")), "tidemark_key")
    # rows that the filter clears stay where they are, however many others go
    suspects = rows.where("tidemark_maybe")
    same = (suspects["tidemark_key"] == found["tidemark_found"]) & suspects["doc_id"].eqNullSafe(found["tidemark_id"])
    return rows.where("not tidemark_maybe").select(docs.columns).unionAll(suspects.join(found, same, "left_anti").select(docs.columns))
