"""Ranked lexical search by NRA: sorted reads only, with score intervals per document.

Documents are read once into postings (document, its number of terms, the
query terms it holds and how often), which gives the counts of the whole
corpus.  Then every task takes its postings in slices of documents, sorts each
term's list by impact, and answers all items on the slice: it reads the lists
of an item's terms in step, from the highest impact down.  A document's score
is at least the sum of the impacts read for it, and at most that sum plus, for
each list in which it has not been met, the impact read last there.  Reading
goes on until no unmet document can reach the best scores known, and every
document that can has equal bounds, which settles membership, ties and scores.
The best scores of a task's slices carry over to its later ones.

Only an item's best rows of a task leave it, so what is shuffled does not grow
with the documents that match.  Items are taken in blocks of bounded bytes;
a block's terms are what is sent to the tasks.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import LOWER, bounded_batches, hashed_words, temporary, text_chunks, tidy, written

TOP = 50
#: Texts of the items of one block, in bytes, about; a longer single item is a block of its own.
BLOCK_BYTES = 8 << 20
#: Postings of a slice, about, and documents at most.
SLICE_POSTINGS = 1 << 20
SLICE_DOCS = 1 << 14
#: Entries that are first read from each list; twice as many each time after.
DEPTH = 64

#: ASCII bytes other than letters and digits separate terms.
BREAKS = np.zeros(256, dtype=bool)
BREAKS[[b for b in range(128) if not chr(b).isalnum()]] = True


def term_hashes(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, hashes of all terms in order, each row's first term) of chunks of rows."""
    for first, last, raw, starts in text_chunks(texts):
        words, at = hashed_words(LOWER[raw], starts, BREAKS)
        yield first, last, words, at


def postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, counts) of each row: its number of terms, and places in the sorted `vocabulary` with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for first, last, words, at in term_hashes(batch.column(1)):
                row = np.repeat(np.arange(last - first), np.diff(at))
                place = np.searchsorted(known, words)
                place[place == len(known)] = 0
                wanted = known[place] == words if len(known) else np.zeros(len(words), dtype=bool)
                key, count = np.unique(row[wanted] * len(known) + place[wanted], return_counts=True)
                owner = key // max(1, len(known))
                bounds = pa.array(np.searchsorted(owner, np.arange(last - first + 1)).astype(np.int32))
                terms = pa.ListArray.from_arrays(bounds, pa.array((key - owner * len(known)).astype(np.int32)))
                counts = pa.ListArray.from_arrays(bounds, pa.array(count.astype(np.int64)))
                out = [batch.column(0).slice(first, last - first), pa.array(np.diff(at).astype(np.int64)), terms, counts]
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n", "terms", "counts"])

    return docs.select("doc_id", "text").mapInArrow(read, "doc_id long, n long, terms array<int>, counts array<long>")


class Items:
    """The items of a block: each one's terms as places in the sorted vocabulary."""

    def __init__(self, keys: list[int], terms: list[np.ndarray]):
        self.keys = keys
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *terms]))
        self.terms = [np.searchsorted(self.vocabulary, t) for t in terms]

    @classmethod
    def of(cls, rows: list) -> Items:
        texts = pa.array([r["text"] for r in rows], pa.string())
        terms: list[np.ndarray] = []
        for first, last, words, at in term_hashes(texts):
            terms += [np.unique(words[at[k] : at[k + 1]]) for k in range(last - first)]
        return cls([r["tidemark_item"] for r in rows], terms)


def impacts(weight: np.ndarray, counts: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term adds to a document's score, in 64-bit integers; n: the document's terms."""
    m = 100 - 50 + (50 * n * documents) // max(1, length)
    return weight * ((1_000_000_000 * counts) // (1000 * counts + 20 * m))


class Slice:
    """Impact-sorted lists of some documents: of term t, `doc[at[t]:at[t + 1]]` with falling `impact`."""

    def __init__(self, vocabulary: int, documents: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        some = impact > 0
        term, doc, impact = term[some], doc[some], impact[some]
        order = np.lexsort((-impact, term))
        self.documents, self.doc, self.impact = documents, doc[order], impact[order]
        self.at = np.searchsorted(term[order], np.arange(vocabulary + 1))

    def best(self, terms: np.ndarray, top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores): all documents of the slice that are among its `top` or tie with the last of them, and reach `floor`.

        Sequential reads of sorted lists only; the scores are final.
        """
        lists = [(self.at[t], self.at[t + 1]) for t in terms if self.at[t] < self.at[t + 1]]
        lower = np.zeros(self.documents, dtype=np.int64)
        if not lists:
            return np.zeros(0, dtype=np.int64), lower[:0]
        read, depth = 0, DEPTH
        while True:
            unmet = 0
            # of each document: the bounds of the lists in which it was met
            met = np.zeros(self.documents, dtype=np.int64)
            for begin, end in lists:
                now = slice(begin + read, min(end, begin + depth))
                if now.start < now.stop:
                    lower[self.doc[now]] += self.impact[now]
                if begin + depth < end:
                    bound = self.impact[begin + depth]
                    unmet += bound
                    met[self.doc[begin : begin + depth]] += bound
            touched = np.flatnonzero(lower)
            least = max(floor, 1)
            if len(touched) > top:
                least = max(least, int(np.partition(lower[touched], len(touched) - top)[len(touched) - top]))
            open_ = unmet - met[touched]
            candidates = touched[lower[touched] + open_ >= least]
            if unmet < least and not (unmet - met[candidates]).any():
                return candidates, lower[candidates]
            read, depth = depth, 2 * depth


def _merged(have: tuple, new: tuple, top: int) -> tuple:
    """The best `top` of two lists (score, unnamed, doc_id): highest score, then least doc_id, rows without id last."""
    score, unnamed, doc = (np.concatenate(x) for x in zip(have, new, strict=True))
    order = np.lexsort((doc, unnamed, -score))[:top]
    return score[order], unnamed[order], doc[order]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches together up to the size of a slice; a batch larger than one is cut."""
    held: list[pa.RecordBatch] = []
    docs = entries = 0
    for batch in batches:
        sizes = np.diff(batch.column(2).offsets.to_numpy())
        first = 0
        while first < batch.num_rows:
            room = np.searchsorted(np.cumsum(sizes[first:]), SLICE_POSTINGS - entries, side="right")
            last = min(batch.num_rows, first + SLICE_DOCS - docs, first + max(int(room), 0 if held else 1))
            if last > first:
                held.append(batch.slice(first, last - first))
                docs, entries = docs + last - first, entries + int(sizes[first:last].sum())
                first = last
            if first < batch.num_rows:
                yield held
                held, docs, entries = [], 0, 0
    if held:
        yield held


def _block(table: DataFrame, items: Items, top: int) -> DataFrame:
    """(tidemark_item, doc_id, score): of each item, the best rows of every task."""
    totals = table.where("n > 0").agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    documents, length = int(totals["documents"]), int(totals["length"])
    # one number per term of the block
    frequency = np.zeros(len(items.vocabulary), dtype=np.int64)
    for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        frequency[r[0]] = r[1]
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequency], dtype=np.int64)
    shared = table.sparkSession.sparkContext.broadcast((items.keys, items.terms, weight))

    @tidy
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, terms, weight = shared.value
        none = np.zeros(0, dtype=np.int64)
        best = [(none, none, none)] * len(keys)
        for held in _slices(batches):
            columns = pa.Table.from_batches(held).combine_chunks()
            doc_id, n = columns.column(0).combine_chunks(), columns.column(1).to_numpy()
            unnamed = doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = doc_id.fill_null(0).to_numpy(zero_copy_only=False)
            lists = columns.column(2).combine_chunks()
            doc = np.repeat(np.arange(columns.num_rows), np.diff(lists.offsets.to_numpy()))
            term = lists.flatten().to_numpy()
            counts = columns.column(3).combine_chunks().flatten().to_numpy()
            own = Slice(len(weight), columns.num_rows, term, doc, impacts(weight[term], counts, n[doc], documents, length))
            for k, wanted in enumerate(terms):
                floor = int(best[k][0][-1]) if len(best[k][0]) == top else 0
                found, score = own.best(wanted, top, floor)
                if len(found):
                    best[k] = _merged(best[k], (score, unnamed[found], ids[found]), top)
        for k, (score, nameless, ids) in enumerate(best):
            if len(score):
                named = pa.array(ids, pa.int64(), mask=nameless.astype(bool))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), keys[k])), named, pa.array(score)], names=["tidemark_item", "doc_id", "score"])

    found = table.mapInArrow(search, "tidemark_item long, doc_id long, score long")
    order = Window.partitionBy("tidemark_item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's `top` documents with a score above 0.

    Terms are runs of letters, digits and non-ASCII characters, A-Z
    lower-cased; an item's terms count once each.  Null and empty texts have
    none: such items find nothing, such documents are not found and not
    counted.  Equal scores go by doc_id, a null one last; repeated document
    rows are documents of their own, repeated items are answered each, and
    other columns are ignored.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with temporary(spark):
        own = items.select("item_id", "text").where("text is not null").withColumn("tidemark_item", F.monotonically_increasing_id())
        own = written(own, spark, keep=True)
        # items are cut into blocks by their bytes; the driver holds one block at a time
        blocks = max(1, -(-int(own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]) // block_bytes))
        parts = []
        for b in range(blocks):
            block = Items.of(own.where(F.pmod(F.xxhash64("tidemark_item"), F.lit(blocks)) == b).select("tidemark_item", "text").collect())
            parts.append(written(_block(written(postings(docs, block.vocabulary)), block, top), keep=True))
    found = functools.reduce(DataFrame.unionByName, parts)
    return found.join(own.select("tidemark_item", "item_id"), "tidemark_item").select("item_id", "rank", "doc_id", "score")
