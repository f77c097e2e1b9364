"""Shared pieces of the training-data operators: tables, scratch space, hashed words.

Texts are handled as UTF-8 bytes.  Rows are processed in chunks of about
`CHUNK` bytes, so the memory of a task depends on the longest single text and
not on the number of rows in a partition.
"""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 19

#: ASCII white space: blank, tab, newline, vertical tab, form feed, return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# A random 64-bit value per byte and an odd base give a polynomial hash whose
# prefix sums turn into word hashes without a loop over words.
_RNG = np.random.default_rng(20240117)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_STEP = [0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column) -> F.Column:
    """crc32 of an id as text, modulo 5: the split into training and held-out rows."""
    return F.crc32(column.cast("string")) % 5


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared `spark.checkpoint.dir`; a local one only where it is unset in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: intermediate tables need a folder that all nodes share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


_STEPS: list[list[str]] = []


def written(df: DataFrame, spark: SparkSession | None = None, keep: bool = False) -> DataFrame:
    """Write `df` to shared storage and read it back: cuts lineage, survives lost executors.

    Within `temporary`, the table goes at the end of the block, unless it is to be kept.
    """
    spark = spark or df.sparkSession
    path = scratch_dir(spark)
    df.write.parquet(path)
    open_blocks = _STEPS[:-1] if keep else _STEPS
    if open_blocks:
        open_blocks[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables that are written in the block are deleted at its end; what leaves it must be written to be kept."""
    _STEPS.append([])
    try:
        yield
    finally:
        for path in _STEPS.pop():
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        # lets Spark drop the shuffle files and broadcasts of plans that are gone
        spark._jvm.System.gc()


#: Words of a key filter at most (two numbers each when broadcast), and its bits for each key while there is room.
FILTER_WORDS = 1 << 20
KEY_BITS = 16
KEY_PROBES = 3


class KeyFilter:
    """A Bloom filter of keys, of bounded size, as column expressions: it tells the rows that need no join.

    Each key sets a few bits of one 64-bit word.  The words are broadcast,
    FILTER_WORDS of them at most however many keys there are; more keys than
    that holds give more false positives, and no key is ever missed.  So a
    large table meets a list of keys of any length with one plan: most rows
    stay where they are, and only those that pass are shuffled to be joined.
    """

    def __init__(self, keys: DataFrame, key: str):
        hashes = keys.select(F.xxhash64(key).alias("tidemark_hash")).where(F.col(key).isNotNull())
        self.words = max(1, min(FILTER_WORDS, -(-hashes.count() * KEY_BITS // 64)))
        marks = hashes.select(self._word().alias("tidemark_word"), self._bits().alias("tidemark_bits"))
        self.table = written(marks.groupBy("tidemark_word").agg(F.bit_or("tidemark_bits").alias("tidemark_bits")), keep=True)

    def _word(self) -> F.Column:
        return F.pmod(F.col("tidemark_hash"), F.lit(self.words))

    @staticmethod
    def _bits() -> F.Column:
        """The key's bits, from a second hash."""
        one = [f"shiftleft(1L, int(shiftright(xxhash64(tidemark_hash), {6 * i}) & 63))" for i in range(KEY_PROBES)]
        return F.expr(" | ".join(one))

    def marked(self, rows: DataFrame, key: str) -> DataFrame:
        """`rows` with `tidemark_maybe`: false where the key is surely not in the filter."""
        x = rows.withColumn("tidemark_hash", F.xxhash64(key))
        x = x.withColumns({"tidemark_word": self._word(), "tidemark_mine": self._bits()}).join(F.broadcast(self.table), "tidemark_word", "left")
        hit = F.coalesce(F.col("tidemark_bits").bitwiseAND(F.col("tidemark_mine")) == F.col("tidemark_mine"), F.lit(False)) & F.col(key).isNotNull()
        return x.withColumn("tidemark_maybe", hit).drop("tidemark_hash", "tidemark_word", "tidemark_mine", "tidemark_bits")

    def passing(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows whose key may be in the filter."""
        return self.marked(rows, key).where("tidemark_maybe").drop("tidemark_maybe")


#: Bytes of a batch on its way to a Python worker, about.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so that long texts don't add up in a worker, unless the session sets a bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name, str(2**31 - 1)).rstrip("b")) >= 2**31 - 1:
        spark.conf.set(name, str(BATCH_BYTES))


def tidy(function):
    """A mapInArrow function that gives its memory back when it ends.

    Spark keeps Python workers for later tasks, and what one step has cached
    would stay beside the next one's.
    """

    @functools.wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _POWERS.clear()
            pa.default_memory_pool().release_unused()

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, document starts) of runs of rows.

    Every document is followed by one blank, which is part of its byte range;
    a null text is an empty one.
    """
    texts = texts.fill_null("")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    first, n = 0, len(sizes)
    while first < n:
        total, last = int(sizes[first]), first + 1
        while last < n and total + sizes[last] <= limit:
            total += int(sizes[last])
            last += 1
        rows = texts.slice(first, last - first).to_pylist()
        raw = np.frombuffer((" ".join(rows) + " ").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        starts = np.zeros(last - first + 1, dtype=np.int64)
        np.cumsum(sizes[first:last] + 1, out=starts[1:])
        yield first, last, raw, starts
        first = last


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + (CHUNK >> 1))
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= CHUNK * 4:
            _POWERS[base] = have
    return have[:n]


def hashed_words(raw: np.ndarray, starts: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a chunk, and each document's first word.

    `raw` is already lower-cased; `breaks` marks the bytes between words.
    """
    gap = breaks[raw]
    edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * _powers(len(raw), _BASE), out=sums[1:])
    words = mix((sums[end] - sums[begin]) * _powers(len(raw) + 1, _BASE_INV)[begin])
    return words, np.searchsorted(begin, starts)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text: `width` words each.

    A text of fewer words has its whole sequence as its one shingle; a text
    without words has none.
    """
    for first, _, raw, starts in text_chunks(texts):
        words, at = hashed_words(LOWER[raw], starts)
        full = max(0, len(words) - width + 1)
        joined = np.zeros(full, dtype=np.uint64)
        for i in range(width):
            joined += words[i : i + full] * np.uint64(_STEP[i])
        joined = mix(joined)
        for k in range(len(at) - 1):
            a, b = int(at[k]), int(at[k + 1])
            if b - a >= width:
                yield first + k, np.unique(joined[a : b - width + 1])
            elif b > a:
                short = np.uint64(b - a)
                for i in range(b - a):
                    short = short + words[a + i : a + i + 1] * np.uint64(_STEP[i])
                yield first + k, mix(np.atleast_1d(short))
            else:
                yield first + k, np.zeros(0, dtype=np.uint64)


def group_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups of rows sorted by `keys`; a group never straddles two tables."""
    rest: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if rest is not None and rest.num_rows:
            now = pa.concat_tables([rest, now])
        cut = now.num_rows
        tail = [now.column(k)[cut - 1] for k in keys]
        # the last group may go on in the next batch
        same = np.ones(cut, dtype=bool)
        for k, v in zip(keys, tail, strict=True):
            same &= now.column(k).to_numpy(zero_copy_only=False) == v.as_py()
        begin = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if begin:
            yield now.slice(0, begin).combine_chunks()
        rest = now.slice(begin)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def group_starts(run: pa.Table, keys: list[str]) -> np.ndarray:
    """Positions at which a new group begins, and the number of rows."""
    change = np.zeros(run.num_rows, dtype=bool)
    change[:1] = True
    for k in keys:
        column = run.column(k).to_numpy(zero_copy_only=False)
        change[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(change), run.num_rows)
