"""Packing into fixed windows by multiway differencing (Karmarkar-Karp).

Each text becomes token ids plus an end id.  Full windows are cut off first;
what remains of a document is cut into pieces of at most `piece` tokens.  The
pieces are dealt to groups of bounded size by hash, and each group is packed
on its own: partial partitions with the largest imbalance are merged so that
the largest window of one meets the smallest of the other, until one partition
with near-equal windows is left.  If a window exceeds the capacity, the number
of windows rises and the group is packed again.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, text_chunks, tidy, written

WINDOW = 1024
PIECE = 256
#: Pieces in a group, about.
GROUP = 4096
SEQUENCE_BITS = 24

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Encoder:
    """Ids of a byte-level BPE file, in one process; loaded once per worker.

    Where the ranks of the same vocabulary are at hand, the faster encoder
    makes the ids; texts with special-token marks go to the main one.
    """

    def __init__(self, tokenizer: str, ranks: str | None, special: list[str]):
        self.path, self.special = tokenizer, special
        self.main = self.fast = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is not None and not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        if self.main is None:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.main = Tokenizer.from_file(self.path)
        return self.main.encode(text, add_special_tokens=False).ids


_ENCODERS: dict[tuple, Encoder] = {}


def special_marks(tokenizer: str) -> list[str]:
    with open(tokenizer, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file).get("added_tokens", [])]


def encoder(tokenizer: str, ranks: str | None, special: list[str]) -> Encoder:
    if (tokenizer, ranks) not in _ENCODERS:
        _ENCODERS[tokenizer, ranks] = Encoder(tokenizer, ranks, special)
    return _ENCODERS[tokenizer, ranks]


def cut(tokens: int, window: int = WINDOW, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then near-equal parts of the rest."""
    full = tokens // window
    out = [(i * window, window) for i in range(full)]
    rest = tokens - full * window
    if rest:
        parts = -(-rest // piece)
        edges = [full * window + rest * i // parts for i in range(parts + 1)]
        out += [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return out


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None, window: int = WINDOW, piece: int = PIECE, end_id: int = 0) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of each piece; a null text is empty."""
    special = special_marks(tokenizer)

    @tidy
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks, special)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for first, last, _, _ in text_chunks(texts):
                out = []
                for row in range(first, last):
                    ids = np.array([*encode(texts[row].as_py()), end_id], dtype="<u4")
                    doc = batch.column(0)[row].as_py()
                    out += [(doc, a, n, zlib.crc32(ids[a : a + n].tobytes()), len(ids)) for a, n in cut(len(ids), window, piece)]
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(make, _SCHEMA)


def differencing(lengths: np.ndarray, k: int) -> np.ndarray:
    """Window of each item: k-way largest differencing."""
    n = len(lengths)
    left, right = [-1] * n, [-1] * n  # nodes over n join two window contents
    heap = []
    for i, x in enumerate(lengths.tolist()):
        heap.append((-x, i, np.array([x], dtype=np.int64), np.array([i], dtype=np.int64)))
    heapq.heapify(heap)
    tie = n
    while len(heap) > 1:
        _, _, a, ca = heapq.heappop(heap)
        _, _, b, cb = heapq.heappop(heap)
        la, lb = len(a), len(b)
        over = max(0, la + lb - k)
        if over:
            # a's least windows meet b's least: the largest of one goes with the smallest of the other
            sums = np.concatenate([a[: la - over], a[la - over :] + b[lb - over :][::-1], b[: lb - over][::-1]])
            joined = np.arange(len(left), len(left) + over)
            left += ca[la - over :].tolist()
            right += cb[lb - over :][::-1].tolist()
            content = np.concatenate([ca[: la - over], joined, cb[: lb - over][::-1]])
        else:
            sums, content = np.concatenate([a, b]), np.concatenate([ca, cb])
        order = np.argsort(-sums, kind="stable")
        sums, content = sums[order], content[order]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)
        heapq.heappush(heap, (-spread, tie, sums, content))
        tie += 1
    out = np.zeros(n, dtype=np.int64)
    if n:
        for w, top in enumerate(heap[0][3].tolist()):
            stack = [top]
            while stack:
                x = stack.pop()
                if x < n:
                    out[x] = w
                else:
                    stack += [left[x], right[x]]
    return out


def pack_group(lengths: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Window number of each piece; no window holds more than `window` tokens."""
    out = np.zeros(len(lengths), dtype=np.int64)
    full = np.flatnonzero(lengths >= window)
    out[full] = np.arange(len(full))
    rest = np.flatnonzero(lengths < window)
    if len(rest):
        total = int(lengths[rest].sum())
        k = -(-total // window)
        while True:
            own = differencing(lengths[rest], k)
            most = int(np.bincount(own, weights=lengths[rest]).max())
            if most <= window:
                break
            # about half of the excess, spread over all windows
            k = max(k + 1, -(-total // max(1, window - (most - window) // 2)) if most < 2 * window else 0)
        out[rest] = own + len(full)
    return out


def packed(parts: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """`parts` with sequence_id and offset; sequences are gapless and hold `window` tokens at most."""
    parts = written(parts)
    groups = max(1, -(-parts.count() // group))
    # the place in the written table tells repeated rows apart, so that they spread over the groups
    place = F.monotonically_increasing_id()
    dealt = parts.withColumn("g", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", place), F.lit(groups)))

    def fill(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32")])
        length = rows.column("length").to_numpy()
        own = pack_group(length, window)
        order = np.argsort(own, kind="stable")
        before = np.cumsum(length[order]) - length[order]
        begin = np.append(True, own[order][1:] != own[order][:-1])
        offset = np.zeros(len(length), dtype=np.int64)
        offset[order] = before - np.repeat(before[begin], np.diff(np.append(np.flatnonzero(begin), len(length))))
        sequence = rows.column("g").to_numpy() * (1 << SEQUENCE_BITS) + own
        return rows.drop_columns("g").append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return dealt.groupBy("g").applyInArrow(fill, _SCHEMA + ", sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Null and empty texts are one end id.  Repeated rows are packed once each,
    and ids pass unchanged, null ones too; other columns are ignored; an empty
    table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    return packed(pieces(docs, tokenizer, ranks, window), window)
