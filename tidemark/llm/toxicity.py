"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text is a bag of its words and of the character n-grams inside them, hashed
to buckets.  Bucket embeddings and the softmax over their average are trained
together in numpy on a bounded sample of labelled documents, so an unseen
misspelling shares the vectors of the n-grams it keeps.  Because the model is
linear in the average, scoring needs one number per bucket; whole texts are
scored, and so is every passage, and a small logistic regression joins the
text's and its strongest passages' log-odds.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, mix, text_chunks, tidy

BUCKETS = 1 << 18
ORDERS = (3, 4, 5)
DIM = 4
#: Texts shown in training, about; at least six rounds over the sample and sixty at most.
SHOWN = 24_000
#: A bucket that fewer texts of the sample hold has no vector: it could only single texts out.
LEAST_TEXTS = 3
#: The sample of labelled documents that the classifier is fitted on holds at most so many of each class.
SAMPLE = {1: 3000, 0: 5000}
#: Bytes of the longest text in that sample: with SAMPLE it bounds what the driver holds (usually a thirtieth of it).
LONGEST = 1 << 16
#: Bytes of a passage.
PASSAGE = 256
SCALE = 64.0
#: Least total weight of a passage's average.
FLOOR = 32.0

_CLEAN = LOWER.copy()
_CLEAN[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def subwords(raw: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order: (buckets, fits) of the n-grams at each byte; fits: the n-gram lies within one word or touches its ends."""
    clean = _CLEAN[raw]
    wide = clean.astype(np.uint64)
    blank = np.concatenate(([0], np.cumsum(clean == 0x20)))
    out = []
    for n in ORDERS:
        m = max(0, len(raw) - n + 1)
        key = np.full(m, n, dtype=np.uint64)
        for i in range(n):
            key = (key << np.uint64(8)) | wide[i : i + m]
        inner = blank[n - 1 : n - 1 + m] - blank[1 : 1 + m]
        ends = (clean[:m] == 0x20).astype(np.int8) + (clean[n - 1 : n - 1 + m] == 0x20)
        out.append(((mix(key) & np.uint64(BUCKETS - 1)).astype(np.int32), (inner == 0) & (ends < 2)))
    return out


@dataclass
class Model:
    """`value` is each bucket's share of the log-odds, times its weight in an average; `join` weighs
    bias, text, strongest and third strongest passage."""

    value: np.ndarray
    weight: np.ndarray
    bias: float
    join: np.ndarray

    def features(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Per document: 1, log-odds of its average, of its strongest passage, of its second strongest."""
        n = len(raw)
        total, count = np.zeros(n + 1), np.zeros(n + 1)
        for buckets, fits in subwords(raw):
            m = len(buckets)
            # an n-gram that begins at the blank after a document belongs to the next one
            fits[starts[1:][starts[1:] <= m] - 1] = False
            total[1 : m + 1] += np.where(fits, self.value[buckets], 0.0)
            count[1 : m + 1] += np.where(fits, self.weight[buckets], 0.0)
        np.cumsum(total, out=total)
        np.cumsum(count, out=count)
        out = np.zeros((len(starts) - 1, 4))
        out[:, 0] = 1
        for d, (a, z) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            grid = np.arange(a, z, PASSAGE // 2)
            stop = np.minimum(grid + PASSAGE, z)
            sums, counts = total[stop] - total[grid], count[stop] - count[grid]
            odds = np.sort(self.bias + sums / np.maximum(counts, FLOOR))
            out[d, 1] = self.bias + (total[z] - total[a]) / max(count[z] - count[a], FLOOR)
            out[d, 2] = odds[-1]
            out[d, 3] = odds[-3] if len(odds) > 2 else odds[0]
        return out

    def score(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(raw, starts) @ self.join, -30, 30)))


def train(bags: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, texts: list[tuple[np.ndarray, np.ndarray]], prior: float, seed: int = 11) -> Model:
    """Fit embeddings and softmax on bags of buckets, then the weights that join a text's parts."""
    if not len(toxic) or toxic.min() == toxic.max():
        rate = min(0.999, max(0.001, float(toxic.mean()) if len(toxic) else 0.001))
        return Model(np.zeros(BUCKETS, dtype=np.float32), np.ones(BUCKETS, dtype=np.float32), 0.0, np.array([np.log(rate / (1 - rate)), 0, 0, 0]))
    found = np.zeros(BUCKETS)
    for buckets, _ in bags:
        found[buckets] += 1
    # frequent n-grams weigh less, and those without a vector nothing
    weight = np.log((len(bags) + 1) / (found + 0.5)).clip(0.02).astype(np.float32)
    weight[found < LEAST_TEXTS] = 0.0
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32) * 0.1
    soft = rng.standard_normal((DIM, 2)).astype(np.float32) * 0.1
    bias = np.zeros(2, dtype=np.float32)
    table_sum, soft_sum, bias_sum = np.full((BUCKETS, 1), 1e-6, np.float32), np.full((DIM, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    share = np.array([1 - toxic.mean(), toxic.mean()])
    epochs = int(np.clip(-(-SHOWN // len(bags)), 6, 60))
    for epoch in range(epochs):
        rate = 0.25 * (1 - epoch / epochs)
        for i in rng.permutation(len(bags)):
            bag, times = bags[i]
            fine = found[bag] >= LEAST_TEXTS
            bag, times = bag[fine], times[fine]
            if not len(bag):
                continue
            part = weight[bag] * times
            part *= SCALE / part.sum()
            rows = table[bag]
            mean = part @ rows
            z = mean @ soft + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(toxic[i])] -= 1
            p *= 0.5 / share[int(toxic[i])]
            g = part[:, None] * (soft @ p)
            gs = np.outer(mean, p)
            table_sum[bag] = scale = table_sum[bag] + (g * g).mean(axis=1, keepdims=True)
            table[bag] = rows - rate * g / np.sqrt(scale)
            soft_sum += gs * gs
            soft -= 0.1 * rate * gs / np.sqrt(soft_sum)
            bias_sum += p * p
            bias -= 0.1 * rate * p / np.sqrt(bias_sum)
    model = Model((table @ (soft[:, 1] - soft[:, 0]) * SCALE * weight).astype(np.float32), weight, float(bias[1] - bias[0]), np.array([0.0, 1, 0, 0]))
    rows = np.concatenate([model.features(raw, starts) for raw, starts in texts])
    size = np.append(1, rows[:, 1:].std(axis=0) + 1e-9)
    x, y = rows / size, toxic.astype(float)
    # the sample holds the classes in other shares than the corpus
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    w = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 1e-2 * w * np.array([0, 1, 1, 1])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.diag([1e-6, 1, 1, 1])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    model.join = w / size
    return model


def _bags(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    buckets, times = np.unique(np.concatenate([b[f] for b, f in subwords(raw)]), return_counts=True)
    return buckets, times.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None, longest: int = LONGEST) -> Model:
    """Learn from labels (doc_id, toxic) and the texts of `docs`.

    At most `sample` documents of each class are used, the first by a hash of
    the id, and of these the ones of at most `longest` bytes; labels other than 0 and 1 teach nothing, and an id that is labelled
    twice counts as toxic if either label is.
    """
    sample = sample or SAMPLE
    known = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for c, n in sample.items():
        part = known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = part if chosen is None else chosen.unionAll(part)
    # the chosen ids are bounded by `sample`
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= longest).join(F.broadcast(chosen), "doc_id").select("toxic", "text").toArrow()
    rows = rows.sort_by([("toxic", "ascending"), ("text", "ascending")])
    toxic = rows.column("toxic").to_numpy()
    # the bags lie in two flat arrays, which are given back whole
    buckets, times, ends, raws = array("i"), array("f"), [0], []
    for text in rows.column("text"):
        raw = np.frombuffer((text.as_py() + " ").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        bag, number = _bags(raw)
        buckets.frombytes(bag.astype(np.int32).tobytes())
        times.frombytes(number.tobytes())
        ends.append(len(buckets))
        raws.append((raw, np.array([0, len(raw)])))
    del rows
    buckets, times = np.frombuffer(buckets, dtype=np.int32), np.frombuffer(times, dtype=np.float32)
    bags = [(buckets[a:z], times[a:z]) for a, z in zip(ends[:-1], ends[1:], strict=True)]
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    return train(bags, toxic, raws, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of each row from its whole text alone.

    Null and empty texts get the score of a text without words.  Repeated rows
    get equal scores; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [shared.value.score(raw, starts) for _, _, raw, starts in text_chunks(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0), *parts]))], names=["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` without the rows that the model predicts to be toxic, scored in place; nothing is joined."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [shared.value.score(raw, starts) for _, _, raw, starts in text_chunks(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0), *parts]) < 0.5))

    return docs.mapInArrow(run, docs.schema)
