"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts of up to four bytes.  A byte is coded in
the longest context that has seen it; each context that has not costs an
escape (method D: half the number of its distinct bytes), and bytes that a
longer context has seen are excluded from the shorter one.  The code length of
a byte is thus a function of five bytes, so the corpus is reduced to counts of
five-byte windows, and the trie is evaluated once per distinct window, in
groups of contexts that end in the same two bytes.

Texts never leave their scan task.  Frequent words and windows are looked up
in a table of fixed size there; each occurrence of any other goes through a
shuffle by its key, where its count or code length is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, fold, group_runs, group_starts, hashed_words, mix, text_chunks, tidy, written

ORDER = 4
#: A byte that ends each text and bytes that stand before it; neither occurs in UTF-8.
END, BEFORE = 0xFF, 0xFE
#: Slots of a lookup table; a key that is no less frequent than one in SHARE may have one.
SLOTS = 1 << 21
SHARE = 1 << 23


def windows(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(five-byte windows, document of each): one for every byte of a text and one for its end."""
    n = len(starts) - 1
    sizes = np.diff(starts)
    # each document's last byte is the blank that text_chunks adds: it becomes the end
    wide = np.full(len(raw) + ORDER * n, BEFORE, dtype=np.uint64)
    doc = np.repeat(np.arange(n), sizes)
    at = np.arange(len(raw)) + (doc + 1) * ORDER
    wide[at] = raw
    wide[starts[1:] - 1 + (np.arange(n) + 1) * ORDER] = END
    key = np.zeros(len(raw), dtype=np.uint64)
    for i in range(ORDER, -1, -1):
        key = (key << np.uint64(8)) | wide[at - i]
    return key, doc


def _counted(keys: np.ndarray, n: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n, t = keys[order], n[order], t[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return (keys[at], np.add.reduceat(n, at), np.add.reduceat(t, at)) if len(at) else (keys, n, t)


def counts(docs: DataFrame) -> DataFrame:
    """(kind, key, n, t): occurrences of words (0) and windows (1) in all of `docs` and in its training rows."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: tuple[list, list] = ([], [])

        def add(kind: int, keys: np.ndarray, teaches: np.ndarray) -> None:
            a, na = np.unique(keys[teaches], return_counts=True)
            b, nb = np.unique(keys[~teaches], return_counts=True)
            have[kind].append((np.concatenate([a, b]), np.concatenate([na, nb]), np.concatenate([na, np.zeros_like(nb)])))
            if len(have[kind]) >= 8:
                have[kind][:] = [_counted(*map(np.concatenate, zip(*have[kind], strict=True)))]

        for batch in batches:
            train = ~batch.column(1).to_numpy(zero_copy_only=False)
            for first, last, raw, starts in text_chunks(batch.column(0)):
                raw, own = LOWER[raw], train[first:last]
                words, at = hashed_words(raw, starts)
                add(0, words, np.repeat(own, np.diff(at)))
                keys, doc = windows(raw, starts)
                add(1, keys, own[doc])
        for kind in (0, 1):
            if have[kind]:
                k, n, t = _counted(*map(np.concatenate, zip(*have[kind], strict=True)))
                for a in range(0, len(k), 10000):
                    part = k[a : a + 10000].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, dtype=np.int32)), pa.array(part), pa.array(n[a : a + 10000]), pa.array(t[a : a + 10000])], names=["kind", "key", "n", "t"])

    found = docs.select("text", "held_out").mapInArrow(count, "kind int, key long, n long, t long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def _byte(column: str, place: int):
    """The byte of a window that stands `place` bytes before its last."""
    return F.shiftright(F.col(column), 8 * place).bitwiseAND(255)


def code_lengths(grams: DataFrame) -> DataFrame:
    """(key, n, lp): log10 probability of each window's last byte after the bytes before it; grams: (key, n, t)."""
    low = grams.where("t > 0").groupBy(_byte("key", 1).alias("c"), _byte("key", 0).alias("s")).agg(F.sum("t").alias("t")).collect()
    one = np.zeros((256, 256), dtype=np.int64)  # 256 x 256 rows at most
    for r in low:
        one[r["c"], r["s"]] = r["t"]
    shared = grams.sparkSession.sparkContext.broadcast(one)

    def level(n: np.ndarray, total: np.ndarray, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 of the byte's share if it has one, log10 of the escape); an empty context escapes for free."""
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.log10((2 * n - 1) / (2 * total))
            escape = np.where(total > 0, np.log10(distinct / (2 * total)), 0.0)
        return own, escape

    @tidy
    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = shared.value
        zero = one.sum(axis=0)
        for run in group_runs(batches, ["suffix"]):
            key, n, t = (run.column(c).to_numpy() for c in ("key", "n", "t"))
            lp = np.zeros(len(key))
            edges = group_starts(run, ["suffix"])
            for a, z in zip(edges[:-1], edges[1:], strict=True):
                k, c = key[a:z], t[a:z]
                s, b4, b2 = k & 255, int(k[0] >> 8) & 255, (k >> 24) & 255
                _, four = np.unique(k >> 8, return_inverse=True)
                three = np.bincount(b2 * 256 + s, weights=c, minlength=65536).astype(np.int64).reshape(256, 256)
                two, first = three.sum(axis=0), one[b4]
                seen = c > 0
                done = seen.copy()
                total4, distinct4 = np.bincount(four, weights=c), np.bincount(four, weights=seen)
                own, cost = level(c, total4[four], distinct4[four])
                value = np.where(done, own, 0.0)
                # exclusion: what the longer context has seen leaves the shorter one's counts
                steps = (
                    (three[b2, s], three.sum(axis=1)[b2] - np.bincount(four[seen], weights=three[b2, s][seen], minlength=len(total4))[four], (three > 0).sum(axis=1)[b2] - distinct4[four]),
                    (two[s], two.sum() - ((three > 0) @ two)[b2], (two > 0).sum() - (three > 0).sum(axis=1)[b2]),
                    (first[s], first.sum() - first[two > 0].sum(), (first > 0).sum() - (two > 0).sum()),
                    (zero[s], zero.sum() - zero[first > 0].sum(), (zero > 0).sum() - (first > 0).sum()),
                )
                for have, total, distinct in steps:
                    total = np.broadcast_to(total, len(k)).astype(float)
                    distinct = np.broadcast_to(distinct, len(k)).astype(float)
                    own, escape = level(have, total, distinct)
                    hit = ~done & (have > 0)
                    value = np.where(hit, cost + own, value)
                    cost, done = cost + escape, done | hit
                value = np.where(done, value, cost - np.log10(max(1, 256 - int((zero > 0).sum()))))
                lp[a:z] = value
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), pa.array(lp)], names=["key", "n", "lp"])

    rows = grams.select(F.shiftright("key", 8).bitwiseAND(65535).alias("suffix"), "key", "n", "t")
    return rows.repartition("suffix").sortWithinPartitions("suffix").mapInArrow(evaluate, "key long, n long, lp double")


class Lookup:
    """A direct-mapped table: a key has one slot, and the most frequent of its keys holds it."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, values: np.ndarray, slots: int = SLOTS):
        order = np.lexsort((keys, n))
        keys, values = keys[order].view(np.uint64), values[order]
        at = self.slot(keys, slots)
        held = np.full(slots, -1, dtype=np.int64)
        held[at] = np.arange(len(keys))  # later ones, more frequent, win
        held = held[held >= 0]
        self.__setstate__((slots, keys[held], values[held]))

    def __getstate__(self) -> tuple:
        return self.slots, self.keys[self.used], self.values[self.used]

    def __setstate__(self, state: tuple) -> None:
        self.slots, keys, values = state
        at = self.slot(keys, self.slots)
        self.used = np.zeros(self.slots, dtype=bool)
        self.keys, self.values = np.zeros(self.slots, dtype=np.uint64), np.zeros(self.slots)
        self.keys[at], self.values[at], self.used[at] = keys, values, True

    @staticmethod
    def slot(keys: np.ndarray, slots: int) -> np.ndarray:
        return (mix(keys) >> np.uint64(20) & np.uint64(slots - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, value) of each key."""
        at = self.slot(keys, self.slots)
        found = (self.keys[at] == keys) & self.used[at]
        return found, np.where(found, self.values[at], 0.0)


def score(docs: DataFrame) -> DataFrame:
    """Scores of each row of `docs` (doc_id, text); see the columns below.

    Learns from the rows whose crc32(doc_id as text) mod 5 is not 1.  A-Z are
    lower-cased first; a null text is empty and has its end alone.  Repeated
    rows count as often as they occur and get a row each; other columns are
    ignored.

    doc_id, held_out; n_tokens, n_known, train_tokens; base_score (unigrams of
    words); score (log10 probability of the lower-cased bytes and the end).
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"))
    found = written(counts(docs))
    words, grams = found.where("kind = 0"), found.where("kind = 1")
    ends = docs.agg(F.count_if(~F.col("held_out")).alias("t")).first()["t"]
    sums = words.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("t") > 0).alias("v")).first()
    total, distinct = sums["t"] + ends, sums["v"] + (ends > 0)
    floor = float(np.log10(total + 0.5 * (distinct + 1)))
    lengths = written(code_lengths(grams))
    bytes_n = lengths.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]

    def frequent(rows: DataFrame, occurrences: int, value: str) -> Lookup:
        # no more than SHARE keys can be that frequent
        some = rows.where(F.col("n") >= max(2, -(-occurrences // SHARE))).select("key", "n", F.col(value).cast("double").alias("x")).toArrow()
        return Lookup(*(some.column(c).to_numpy() for c in ("key", "n", "x")))

    shared = spark.sparkContext.broadcast((frequent(words, sums["n"], "t"), frequent(lengths, bytes_n, "lp")))

    @tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words, known_grams = shared.value
        names = ["uid", "key", "kind", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

        def rows(**columns) -> pa.RecordBatch:
            n = len(columns["uid"])
            return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in zip(names, kinds, strict=True)], names=names)

        for batch in batches:
            uid, ids, held = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
            for first, last, raw, starts in text_chunks(batch.column(3)):
                raw, own, n = LOWER[raw], uid[first:last], last - first
                keys, at = hashed_words(raw, starts)
                doc = np.repeat(np.arange(n), np.diff(at))
                hit, c = known_words.find(keys)
                base = np.bincount(doc[hit], weights=np.log10(c[hit] + 0.5) - floor, minlength=n)
                seen = np.bincount(doc[hit], weights=c[hit] > 0, minlength=n)
                yield rows(uid=own[doc[~hit]], key=keys[~hit].view(np.int64), kind=np.zeros(int((~hit).sum()), dtype=np.int32))
                base += np.log10(ends + 0.5) - floor
                grams, place = windows(raw, starts)
                good, lp = known_grams.find(grams)
                value = np.bincount(place[good], weights=lp[good], minlength=n)
                yield rows(uid=own[place[~good]], key=grams[~good].view(np.int64), kind=np.ones(int((~good).sum()), dtype=np.int32))
                yield rows(uid=own, kind=np.full(n, 2, dtype=np.int32), doc_id=ids.slice(first, n), held_out=held.slice(first, n), n_tokens=np.diff(at) + 1, n_known=(seen + (ends > 0)).astype(np.int64), base=base, score=value)

    marked = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "held_out", "text")
    scanned = written(marked.mapInArrow(scan, "uid long, key long, kind int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"))

    rare = scanned.where("kind < 2").select("uid", "kind", "key")
    rare_words = rare.where("kind = 0").join(words.select("key", "t"), "key").select("uid", (F.col("t") > 0).cast("long").alias("n_known"), (F.log10(F.col("t") + 0.5) - F.lit(floor)).alias("base"), F.lit(0.0).alias("score"))
    rare_grams = rare.where("kind = 1").join(lengths.select("key", "lp"), "key").select("uid", F.lit(0).cast("long").alias("n_known"), F.lit(0.0).alias("base"), F.col("lp").alias("score"))
    more = rare_words.unionAll(rare_grams).groupBy("uid").agg(F.sum("n_known").alias("k"), F.sum("base").alias("b"), F.sum("score").alias("s"))
    out = scanned.where("kind = 2").join(more, "uid", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score"),
    )
