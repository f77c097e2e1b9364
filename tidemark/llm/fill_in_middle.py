"""Fill-in-the-middle training texts by a piece table.

A document is a row of descriptors (buffer, start, length) over two buffers
that never change: its text and the sentinels.  Cutting a document splits the
descriptor that holds the place; an arrangement permutes the descriptors and
puts sentinels between them; the inverse permutation restores the text.  A
text is only put together where it is asked for, and hashes run over the
descriptors one by one.  All decisions come from a hash of the row's id, so a
repeated task gives the same rows, and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tidemark.llm.common import bounded_batches, text_chunks, tidy

TEXT, MARKS = 0, 1
SENTINELS = b"<P><S><M>"
P, S, M = ((MARKS, 3 * i, 3) for i in range(3))
#: Percent of documents that stay plain, from this remainder of the third number on, and of suffix-first ones among the rest.
PLAIN_FROM = 90
SUFFIX_FIRST = 20
SEED = 1

PIECES = "array<struct<buffer:int,start:long,length:long>>"
COLUMNS = f"n long, form string, prefix_chars long, middle_chars long, pieces {PIECES}, output_sha256 string, restored_sha256 string"


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


#: What stands where: sentinels, and the places of prefix (0), middle (1) and suffix (2).
LAYOUT: dict[str, list] = {"psm": [Piece(*P), 0, Piece(*S), 2, Piece(*M), 1], "spm": [Piece(*S), 2, Piece(*P), 0, Piece(*M), 1]}


def cut(pieces: list[Piece], at: int) -> list[Piece]:
    """The same text with a border at byte `at`: the descriptor across it is split; ends may give empty ones."""
    out, seen, done = [], 0, False
    for piece in pieces:
        if not done and at <= seen + piece.length:
            left = at - seen
            out += [piece._replace(length=left), Piece(piece.buffer, piece.start + left, piece.length - left)]
            done = True
        else:
            out.append(piece)
        seen += piece.length
    return out


def arranged(parts: list[Piece], form: str) -> list[Piece]:
    """The descriptors of prefix, middle and suffix in the order of `form`, with its sentinels."""
    return [parts[x] if isinstance(x, int) else x for x in LAYOUT[form]]


def located(output: bytes, form: str) -> list[Piece]:
    """The descriptors of an arranged text over itself, in its own order.

    A text with a sentinel inside is never arranged, and a sentinel cannot
    begin within another one, so the first match is the right one.
    """
    if form not in LAYOUT:
        return [Piece(TEXT, 0, len(output))]
    marks = [x for x in LAYOUT[form] if isinstance(x, Piece)]
    at, out = marks[0].length, []
    for mark in marks[1:]:
        end = output.index(SENTINELS[mark.start : mark.start + mark.length], at)
        out.append(Piece(TEXT, at, end - at))
        at = end + mark.length
    return [*out, Piece(TEXT, at, len(output) - at)]


def inverted(pieces: list[Piece], form: str) -> list[Piece]:
    """The inverse permutation: descriptors of prefix, middle and suffix from those of an arranged text."""
    if form not in LAYOUT:
        return pieces
    order = [x for x in LAYOUT[form] if isinstance(x, int)]
    return [pieces[order.index(i)] for i in range(len(order))]


def stream(pieces: list[Piece], buffers: tuple) -> Iterator[memoryview]:
    for piece in pieces:
        if piece.length:
            yield buffers[piece.buffer][piece.start : piece.start + piece.length]


def sha256(pieces: list[Piece], buffers: tuple) -> str:
    """Hash of the text that the descriptors stand for, without putting it together."""
    out = hashlib.sha256()
    for part in stream(pieces, buffers):
        out.update(part)
    return out.hexdigest()


def numbers(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers from the row's id; a null id counts as an empty one."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]


def unit_starts(raw: np.ndarray) -> np.ndarray:
    """Places where a unit begins: a run of ASCII letters, or one code point of another kind."""
    low = raw | 0x20
    letter = (low >= 0x61) & (low <= 0x7A) & (raw < 0x80)
    begins = (raw & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(begins)


def transform(docs: DataFrame, render: bool = True, seed: int = SEED) -> DataFrame:
    """`docs` with the arrangement of every row: n (units), form, prefix_chars, middle_chars (code points; null if plain),
    pieces (descriptors: buffer 0 is the text in UTF-8, 1 the sentinels), output_sha256, restored_sha256 (of the text
    taken back from the output), and `output`, the arranged text, if `render`.

    A null text is an empty one, and stays plain like every text that holds a
    sentinel.  A null doc_id counts as an empty one, so such rows are cut
    alike at equal lengths; repeated rows give equal results.  Columns with
    the names of results are replaced, all others pass.  An empty table stays
    empty.
    """
    bounded_batches(docs.sparkSession)
    new = StructType.fromDDL(COLUMNS + (", output string" if render else ""))
    kept = [f for f in docs.schema.fields if f.name not in new.names]
    names = [f.name for f in kept]
    schema = StructType([*kept, *new.fields])
    marks = memoryview(SENTINELS)
    sentinels = [SENTINELS[i : i + 3] for i in range(0, 9, 3)]
    piece_type = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))

    @tidy
    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for first, last, raw, starts in text_chunks(batch.column(batch.schema.get_field_index("text"))):
                units = unit_starts(raw)
                at = np.searchsorted(units, starts)
                points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                whole = memoryview(raw.tobytes())
                found: dict[str, list] = {name: [] for name in new.names}
                for k in range(last - first):
                    begin, end = int(starts[k]), int(starts[k + 1]) - 1
                    own = whole[begin:end]
                    n = int(at[k + 1] - at[k]) - 1
                    h = numbers(ids[first + k].as_py(), seed)
                    pieces, form = [Piece(TEXT, 0, end - begin)], "plain"
                    prefix = middle = None
                    if n and h[2] % 100 < PLAIN_FROM and not any(mark in (text := own.tobytes()) for mark in sentinels):
                        form = "spm" if h[3] % 100 < SUFFIX_FIRST else "psm"
                        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
                        # the blank after a document is the unit after its last one
                        one, two = int(units[at[k] + a]), int(units[at[k] + b])
                        prefix, middle = int(points[one] - points[begin]), int(points[two] - points[one])
                        pieces = arranged(cut(cut(pieces, one - begin), two - begin), form)
                    buffers = (own, marks)
                    output = b"".join(stream(pieces, buffers)) if form != "plain" else own.tobytes()
                    back = inverted(located(output, form), form)
                    row = {
                        "n": n, "form": form, "prefix_chars": prefix, "middle_chars": middle, "pieces": [p._asdict() for p in pieces],
                        "output_sha256": sha256(pieces, buffers), "restored_sha256": sha256(back, (memoryview(output), marks)),
                    }
                    if render:
                        row["output"] = output.decode("utf-8", "surrogatepass")
                    for name, value in row.items():
                        found[name].append(value)
                kinds = {"form": pa.string(), "pieces": piece_type, "output": pa.string(), "output_sha256": pa.string(), "restored_sha256": pa.string()}
                made = [pa.array(found[name], kinds.get(name, pa.int64())) for name in new.names]
                old = batch.slice(first, last - first).select(names)
                yield pa.RecordBatch.from_arrays([*old.columns, *made], names=[*names, *new.names])

    return docs.select(*names, *(c for c in ("doc_id", "text") if c not in names)).mapInArrow(arrange, schema)


def restored(rows: DataFrame) -> DataFrame:
    """`rows` (output, form, ...) with `restored`, the text taken back from `output`; a null output gives null.

    A form other than psm and spm is plain.  An output without its form's
    sentinels fails, since it was never arranged so.
    """
    bounded_batches(rows.sparkSession)
    kept = [f for f in rows.schema.fields if f.name != "restored"]
    names = [f.name for f in kept]

    @tidy
    def take_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for output, form in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist(), strict=True):
                if output is None:
                    texts.append(None)
                    continue
                raw = output.encode("utf-8", "surrogatepass")
                texts.append(b"".join(stream(inverted(located(raw, form), form), (memoryview(raw),))).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(texts, pa.string())], names=[*names, "restored"])

    return rows.mapInArrow(take_back, StructType([*kept, *StructType.fromDDL("restored string").fields]))
