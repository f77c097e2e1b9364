"""Language identification by n-gram filters whose entries are language bitmasks.

One Bloom filter holds all n-grams of all languages: every position is a
bitmask with two bits per language, so a single probe (the and of a few
positions) returns all languages that contain an n-gram, and those in which it
is common.  A document's hits are counted per bit and corrected for the
filter's rate of false positives there.  The decision weighs a common n-gram
fully and a rare one by `RARE`, so a few foreign or misspelt words in a
language's texts don't count like its own; the filter itself leaves none out.

The filter is put together in the tasks, a stretch of positions at a time; the
driver only joins the stretches, whose total size is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, mix, text_chunks, tidy, written

#: Positions of the filter: so many for each distinct n-gram, between these bounds (both powers of two).
GRAM_POSITIONS, POSITIONS, MOST_POSITIONS = 8, 1 << 20, 1 << 25
#: Positions that one group of the build holds.
STRETCH = 1 << 16
PROBES = 3
ORDERS = (3, 4)
#: An n-gram is common in a language if at least this share of the language's n-grams of its order equals it.
SHARE = 1e-5
#: What a language's rare n-gram counts in the decision; a common one counts 1.
RARE = 0.25

#: ASCII bytes other than letters separate words; all other bytes are parts of words.
_CLEAN = LOWER.copy()
_CLEAN[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def ngrams(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, document of each) of the byte n-grams that don't span two words."""
    clean = _CLEAN[raw]
    wide = clean.astype(np.uint64)
    blank = np.concatenate(([0], np.cumsum(clean == 0x20)))
    doc = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
    keys, docs = [], []
    for n in ORDERS:
        m = len(raw) - n + 1
        if m < 1:
            continue
        key = np.full(m, n, dtype=np.uint64)
        for i in range(n):
            key = (key << np.uint64(8)) | wide[i : i + m]
        # no blank between the first and the last byte; at most one at the ends
        inner = blank[n - 1 : n - 1 + m] - blank[1 : 1 + m]
        ends = (clean[:m] == 0x20).astype(np.int8) + (clean[n - 1 : n - 1 + m] == 0x20)
        fine = (inner == 0) & (ends < 2) & (doc[:m] == doc[n - 1 : n - 1 + m])
        keys.append(key[fine])
        docs.append(doc[:m][fine])
    none = np.zeros(0)
    return np.concatenate([none.astype(np.uint64), *keys]), np.concatenate([none.astype(np.int32), *docs])


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def ngram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all of `docs` (lang, text)."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[str, list] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for first, last, raw, starts in text_chunks(batch.column(1)):
                keys, doc = ngrams(raw, starts)
                own = langs[first:last]
                for lang in set(own):
                    k, n = np.unique(keys[(own == lang)[doc]], return_counts=True)
                    have.setdefault(lang, []).append((k, n))
                    if len(have[lang]) >= 16:
                        have[lang] = [_merged(*map(np.concatenate, zip(*have[lang], strict=True)))]
        for lang, parts in have.items():
            k, n = _merged(*map(np.concatenate, zip(*parts, strict=True)))
            for a in range(0, len(k), 10000):
                kk, nn = k[a : a + 10000], n[a : a + 10000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(kk), pa.string()), pa.array(kk.view(np.int64)), pa.array(nn, pa.int64())], names=["lang", "gram", "n"])

    return docs.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def places(grams: np.ndarray, positions: int, probes: int) -> Iterator[np.ndarray]:
    """The filter's positions of each n-gram, one array per probe; `positions` is a power of two."""
    h = mix(grams.astype(np.int64).view(np.uint64))
    step = mix(h) | np.uint64(1)
    for i in range(probes):
        yield ((h + np.uint64(i) * step) & np.uint64(positions - 1)).astype(np.int64)


class Filter:
    """The bit-sliced filter: a row of bytes for each position, bit i for language i and bit L + i for its common n-grams."""

    def __init__(self, languages: list[str], masks: np.ndarray, probes: int = PROBES):
        self.languages, self.masks, self.probes = languages, masks, probes
        fill = np.array([float(((masks[:, k // 8] >> np.uint8(k % 8)) & np.uint8(1)).mean()) for k in range(2 * len(languages))])
        #: chance that an n-gram that a language lacks hits its bit all the same
        self.false = fill**probes

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """(n-grams, bytes): the bits of each n-gram; those of `languages_of` and of the common ones."""
        out = None
        for at in places(grams, len(self.masks), self.probes):
            out = self.masks[at] if out is None else out & self.masks[at]
        return out

    def languages_of(self, grams: np.ndarray) -> np.ndarray:
        """(n-grams, languages): whether each language contains each n-gram; never false for one that it was built from."""
        return np.unpackbits(self.bits(grams), axis=1, bitorder="little")[:, : len(self.languages)].astype(bool)

    def decide(self, grams: np.ndarray, doc: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
        """(language index, score) of each document."""
        bits, n = self.bits(grams), len(self.languages)
        total = np.bincount(doc, minlength=documents)
        hits = np.zeros((documents, 2 * n))
        for k in range(2 * n):
            bit = (bits[:, k // 8] >> np.uint8(k % 8)) & np.uint8(1)
            hits[:, k] = np.bincount(doc, weights=bit, minlength=documents)
        hits = np.maximum(0, (hits - total[:, None] * self.false) / np.maximum(1e-9, 1 - self.false))
        value = RARE * np.maximum(0, hits[:, :n] - hits[:, n:]) + hits[:, n:]
        best = value.argmax(axis=1)
        top, among = value[np.arange(documents), best], value.sum(axis=1)
        return best, np.divide(top, among, out=np.zeros(documents), where=among > 0)


def fit(train: DataFrame, share: float = SHARE) -> Filter:
    """The filter of all n-grams of `train` (lang, text); rows with a null lang or text teach nothing.

    Languages are a short list, as a label's values are; n-grams are counted
    and set by Spark, and the driver gets the filter alone, of
    MOST_POSITIONS positions at most.
    """
    counts = written(ngram_counts(train.where("lang is not null and text is not null")))
    counts = counts.withColumn("order", F.when(F.col("gram") < (1 << 32), 3).otherwise(4))
    sums = counts.groupBy("lang", "order").agg(F.sum("n").alias("total"))
    languages = sorted(r[0] for r in sums.select("lang").distinct().collect())
    if not languages:
        return Filter([], np.zeros((1, 1), dtype=np.uint8))
    distinct = counts.agg(F.approx_count_distinct("gram")).first()[0]
    positions = min(MOST_POSITIONS, max(POSITIONS, 1 << (GRAM_POSITIONS * distinct - 1).bit_length()))
    width = -(-2 * len(languages) // 8)
    index = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int") - 1
    marks = counts.join(F.broadcast(sums), ["lang", "order"]).select("gram", index.alias("language"), (F.col("n") >= F.lit(share) * F.col("total")).alias("common"))

    @tidy
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, language = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            common = batch.column(2).to_numpy(zero_copy_only=False)
            for at in places(grams, positions, PROBES):
                yield pa.RecordBatch.from_arrays([pa.array((at // STRETCH).astype(np.int32)), pa.array((at % STRETCH).astype(np.int32)), pa.array(language), pa.array(common)], names=["stretch", "at", "language", "common"])

    def put(table: pa.Table) -> pa.Table:
        at, language = table.column("at").to_numpy(), table.column("language").to_numpy()
        common = table.column("common").combine_chunks().to_numpy(zero_copy_only=False)
        masks = np.zeros((STRETCH, width), dtype=np.uint8)
        for k, rows in ((language, slice(None)), (language + len(languages), common)):
            np.bitwise_or.at(masks, (at[rows], k[rows] // 8), np.uint8(1) << (k[rows] % 8).astype(np.uint8))
        return pa.table({"stretch": table.column("stretch").slice(0, 1), "masks": pa.array([masks.tobytes()], pa.binary())})

    # repeated bits go before a stretch's rows meet, so a group has at most a row for each of its positions and bits
    each = marks.mapInArrow(spread, "stretch int, at int, language int, common boolean").groupBy("stretch", "at", "language").agg(F.max("common").alias("common"))
    masks = np.zeros((positions, width), dtype=np.uint8)
    for r in each.groupBy("stretch").applyInArrow(put, "stretch int, masks binary").toLocalIterator():
        masks[r[0] * STRETCH : (r[0] + 1) * STRETCH] = np.frombuffer(r[1], dtype=np.uint8).reshape(STRETCH, width)
    return Filter(languages, masks)


def identify(docs: DataFrame, model: Filter) -> DataFrame:
    """(doc_id, lang_pred, score) of each row; `und` with score 0 for a null text or one without a letter.

    Only the text is read.  Repeated rows and other columns change nothing;
    ties go to the language that sorts first.  A model without languages
    answers `und` throughout.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            letter = batch.column(2).fill_null(False).to_numpy(zero_copy_only=False)
            names: list[str] = []
            scores: list[np.ndarray] = []
            for first, last, raw, starts in text_chunks(batch.column(1)):
                if own.languages:
                    keys, doc = ngrams(raw, starts)
                    best, value = own.decide(keys.view(np.int64), doc, last - first)
                    ok = letter[first:last]
                    names += [own.languages[b] if o else "und" for b, o in zip(best, ok, strict=True)]
                    scores.append(np.where(ok, value, 0.0))
                else:
                    names += ["und"] * (last - first)
                    scores.append(np.zeros(last - first))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(np.concatenate([np.zeros(0), *scores]))], names=["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", "text", F.col("text").rlike(r"\p{L}").alias("letter"))
    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double")
