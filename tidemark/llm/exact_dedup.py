"""Exact duplicates by two passes over a Bloom filter of text hashes.

The first pass sets the bits of every text's hash in a filter of 64-bit words
and keeps the bits that two or more rows have set: equal texts set the same
bits, so a text that occurs again has all of its bits among them.  The second
pass probes these bits.  Rows that fail the probe hold a text that no other
row has, and go straight to the result; only the rest is shuffled by hash, and
grouped exactly.  A false positive costs a little shuffling and nothing else.

Everything is column expressions and DataFrames.  A text met in a third of all
rows is combined in the tasks before it is shuffled, and the few groups that
hold a thousandth of all rows or more are joined back by a broadcast of at
most a thousand rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import temporary, written

BLANKS = r"[\x20\x09-\x0D]+"
#: Bits of the filter for each row, and bits that a row sets in its word.
ROW_BITS = 16
PROBES = 3
#: A filter of up to so many words (16 bytes each) is broadcast; above that, hashes are shuffled by word, never texts.
BROADCAST_WORDS = 1 << 20
#: Groups of this share of all rows are joined back by a broadcast; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1e-3


def digest(text: Column) -> Column:
    """Lower-case hex sha256 of the text without ASCII white space, in UTF-8; a null text is an empty one."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, ""), 256)


def _word(words: int) -> Column:
    return F.pmod(F.xxhash64("tidemark_sha"), F.lit(words))


def _bits() -> list[Column]:
    """The places, 0 to 63, of a row's bits within its word."""
    other = F.xxhash64("tidemark_sha", F.lit(1))
    return [F.shiftright(other, 6 * i).bitwiseAND(63).cast("int") for i in range(PROBES)]


def repeated_bits(hashes: DataFrame, words: int) -> DataFrame:
    """First pass: (word, bits) of the bits that two or more rows of `hashes` (tidemark_sha) set."""
    marks = hashes.select(_word(words).alias("word"), F.explode(F.array_distinct(F.array(*_bits()))).alias("bit"))
    twice = marks.groupBy("word", "bit").agg(F.count("*").alias("n")).where("n > 1")
    return twice.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def probed(rows: DataFrame, repeated: DataFrame, words: int, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """Second pass: `rows` with `tidemark_maybe`, false where no other row can hold the same text."""
    repeated = repeated.select(F.col("word").alias("tidemark_word"), F.col("bits").alias("tidemark_bits"))
    small = repeated.count() <= broadcast_words
    met = rows.withColumn("tidemark_word", _word(words)).join(F.broadcast(repeated) if small else repeated, "tidemark_word", "left")
    hit = F.coalesce(F.col("tidemark_bits"), F.lit(0).cast("long"))
    every = F.lit(True)
    for bit in _bits():
        every &= F.getbit(hit, bit) == 1
    return met.withColumn("tidemark_maybe", every).drop("tidemark_word", "tidemark_bits")


def _digests(docs: DataFrame) -> DataFrame:
    points = F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    return docs.select("doc_id", digest(F.col("text")).alias("tidemark_sha"), points.alias("points"), F.monotonically_increasing_id().alias("row"))


def exact_duplicates(docs: DataFrame, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of docs (doc_id, text).

    Texts are equal if they are identical without ASCII white space; a null
    text is an empty one, and texts of white space alone equal it.  Of equal
    texts the row with most code points stays, then the one with the least
    doc_id (a null one last), then any one of the rows that repeat it, so each
    group has exactly one row with `kept`.  `keep_id` is the doc_id of that
    row.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    with temporary(spark):
        # written with its row numbers, so that a lost task cannot number rows anew
        rows = written(_digests(docs))
        total = rows.count()
        words = max(1, total * ROW_BITS // 64)
        repeated = written(repeated_bits(rows, words))
        flagged = written(probed(rows, repeated, words, broadcast_words), keep=True)
        rest = flagged.where("tidemark_maybe").drop("tidemark_maybe")
        order = F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
        groups = rest.groupBy("tidemark_sha").agg(F.count("*").alias("size"), F.min(order).alias("best")).where("size > 1")
        groups = written(groups.select("tidemark_sha", "size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")), keep=True)
        hot = groups.where(F.col("size") >= F.lit(HOT_SHARE * total))
    known = rest.join(F.broadcast(hot), "tidemark_sha")
    cold = rest.join(F.broadcast(hot.select("tidemark_sha")), "tidemark_sha", "left_anti").join(groups, "tidemark_sha", "left")
    single = flagged.where("not tidemark_maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("tidemark_sha").alias("text_sha256"))
    shared = known.unionByName(cold)
    own = F.col("size").isNull()
    return single.unionByName(
        shared.select(
            "doc_id",
            F.when(own, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
            (own | (F.col("row") == F.col("keep_row"))).alias("kept"),
            F.col("tidemark_sha").alias("text_sha256"),
        )
    )


def deduplicated(docs: DataFrame, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; the rules are those of `exact_duplicates`.

    Texts are read twice and never shuffled unless the filter finds them
    possibly repeated; those are combined in the tasks first.
    """
    names = docs.columns
    hashes = docs.select(digest(F.col("text")).alias("tidemark_sha"))
    with temporary(docs.sparkSession):
        hashes = written(hashes)
        words = max(1, hashes.count() * ROW_BITS // 64)
        repeated = written(repeated_bits(hashes, words), keep=True)
    rows = probed(docs.withColumn("tidemark_sha", digest(F.col("text"))), repeated, words, broadcast_words)
    order = F.struct((-F.length(F.coalesce("text", F.lit("")))).alias("points"), F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    best = rows.where("tidemark_maybe").groupBy("tidemark_sha").agg(F.min_by(F.struct(*names), order).alias("best"))
    return rows.where("not tidemark_maybe").select(names).unionByName(best.select("best.*"))
