"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact intersection.

Two documents link when the Jaccard similarity of their sets of word shingles
reaches `percent` / 100.  The join is exact (sets are compared as sorted
64-bit hashes):

1. A first pass counts shingles in a small sketch per task and marks the cells
   that are much fuller than chance: shingles of passages that many documents
   share.  This only orders shingles, it never drops one.
2. Each document sends out the first ``n - ceil(t n) + l`` shingles of that
   order (rare ones first).  Similar documents must share l of them, where l
   grows with the size, so a document that shares fewer than the least of its
   possible partners asks for meets nobody: chance matches end here.
3. All documents under one shingle are first compared with one hub alone: the
   document with the largest part of common shingles, which is the original if
   the others are its edited copies.  Components are taken, so groups of near
   copies of any size collapse in one linear step.
4. Shingles are put together by their hub, so that documents which share many
   shingles meet once and not under each of them.  In one order of all groups,
   a document leaves the last ones as long as it sent fewer than l shingles
   there: similar documents share l, so both still stand in the first group
   that they have in common.  Groups that still hold several components are cut into tiles by size band; within a tile pair, bit
   counts of hashed bitmaps bound the overlap of documents of different
   components from above.  In the first of two rounds a document goes on with
   its first possible partner only, which keeps clusters of variants linear;
   groups in which some had more partners take the second round, in which all
   pairs that can still reach the threshold go on.
5. These are compared exactly, and components are taken over all links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import KeyFilter, bounded_batches, group_runs, group_starts, mix, shingle_sets, temporary, tidy, written
from tidemark.llm.components import components

SKETCH_BITS = 22
#: At most so many sketch cells are marked as common: a fixed bound of the broadcast.
COMMON_CELLS = 1 << 18
#: A fourth of this count of rows of two or three numbers is broadcast to find bitmaps and texts' places in pairs; more
#: are joined by a shuffle.
BROADCAST_ROWS = 1 << 20
#: A hub's text is sent once for about so many partners.
PARTNERS = 512
#: A tile holds about so many documents' bitmaps.
TILE = 4096
#: Widest bitmap in bits.
WIDEST = 1 << 15
#: Words (8 bytes) of bitmaps that are compared at a time.
BLOCK = 1 << 20
_LAST = np.uint64(1) << np.uint64(63)


def _key(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def fingerprint(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(n, percent: int):
    """Shingles of which similar documents must share one; also of a column."""
    return n - F.floor((n * percent + 99) / 100) + 1 if isinstance(n, Column) else n - (percent * n + 99) // 100 + 1


def least_shared(n, percent: int):
    """How many of the shingles sent similar documents must share, if n is the size of the smaller one."""
    p = prefix_length(n, percent)
    return F.floor(p / 8) + 1 if isinstance(n, Column) else p // 8 + 1


def band(n: np.ndarray, percent: int) -> np.ndarray:
    """Sizes that can reach the threshold lie in the same band or in adjacent ones."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / percent) + 1e-9).astype(np.int32)


def bitmap_bits(b: int, percent: int) -> int:
    return int(min(WIDEST, max(128, 2 ** np.ceil(np.log2(4 * (100 / percent) ** (b + 1))))))


def bitmap(values: np.ndarray, bits: int) -> np.ndarray:
    at = (mix(values) & np.uint64(bits - 1)).astype(np.int64)
    flags = np.zeros(bits, dtype=np.uint8)
    flags[at] = 1
    return np.packbits(flags, bitorder="little")


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps of 64-bit words (rows) as narrower ones of `size` words: their pieces joined by or."""
    if words.shape[1] == size:
        return words
    return np.bitwise_or.reduce(words.reshape(len(words), words.shape[1] // size, size), axis=1)


def _common_cells(docs: DataFrame, width: int) -> np.ndarray:
    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, total = np.zeros(1 << SKETCH_BITS, dtype=np.int32), 0
        for batch in batches:
            for _, values in shingle_sets(batch.column(0), width):
                np.add.at(cells, (values & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), 1)
                total += len(values)
        mean = total / (1 << SKETCH_BITS)
        least = int(mean + 4 * np.sqrt(mean) + 3)
        hit = np.flatnonzero(cells >= least)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(cells[hit], pa.int64())], names=["cell", "n"])

    found = docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "cell").limit(COMMON_CELLS).select(F.col("cell").cast("int")).toArrow()
    return np.sort(rows.column(0).to_numpy())


def signatures(docs: DataFrame, width: int, percent: int, common: np.ndarray) -> DataFrame:
    """(doc_id, h, fp, n) per row; share (of common shingles, in 255ths), keys, hot (keys in common cells) and bitmap with the first row of each set in a task."""
    marked = docs.sparkSession.sparkContext.broadcast(common)
    names = ["doc_id", "h", "fp", "n", "share", "keys", "hot", "bits"]
    kind = pa.list_(pa.int64())
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), kind, kind, pa.binary()]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    @tidy
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_common = np.zeros(1 << SKETCH_BITS, dtype=bool)
        is_common[marked.value] = True
        seen: set[int] = set()
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1)
            out: list[tuple] = []
            size = 0
            for row, values in shingle_sets(batch.column(2), width):
                n, own = len(values), (ids[row].as_py(), hashes[row].as_py())
                if not n:
                    out.append((*own, None, n, None, None, None, None))
                    continue
                fp = fingerprint(values)
                if fp in seen:
                    out.append((*own, fp, n, None, None, None, None))
                    continue
                seen.add(fp)
                flag = is_common[(values & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
                # rare ones first; the flag takes the place of the hash's top bit
                order = (values & ~_LAST) | np.where(flag, _LAST, np.uint64(0))
                p = min(n, prefix_length(n, percent) + least_shared(n, percent) - 1)
                first = np.argpartition(order, p - 1)[:p]
                bits = bitmap_bits(int(band(np.array([n]), percent)[0]), percent)
                out.append((*own, fp, n, 255 * int(flag.sum()) // n, _key(values[first[~flag[first]]]), _key(values[first[flag[first]]]), bitmap(values, bits).tobytes()))
                size += p
                if len(out) >= 2000 or size >= 1 << 18:
                    yield batch_of(out)
                    out, size = [], 0
            yield batch_of(out)

    schema = "doc_id long, h long, fp long, n long, share int, keys array<long>, hot array<long>, bits binary"
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(make, schema)


def _key_of(doc_id: str, h: str) -> Column:
    """A hash of a row's id and its text's hash: copies of a text under other ids have other keys."""
    return F.xxhash64(F.col(doc_id).cast("long"), h)


def meetings(under: DataFrame, percent: int) -> DataFrame:
    """The rows of `under` (g, m, fp, n, k) in which a set fp can still meet all similar ones.

    k is the number of shingles that the set fp (size n) sent to the group g.
    Similar sets share l of them, so a set with fewer goes, and a group with
    one set says nothing.  Of the rest, a set leaves the last groups of one
    common order while it loses fewer than l shingles: in the first group that
    two similar sets share, both still have all the shingles they share, l or
    more, at that place or later.  Groups too wide for one tile come last, then
    those to which their sets sent few shingles each.
    """
    least = least_shared(F.floor((F.col("n") * percent + 99) / 100), percent)
    sets = Window.partitionBy("fp")
    under = written(under.withColumn("sent", F.sum("k").over(sets)).where(F.col("sent") >= least).drop("sent"))
    groups = under.groupBy("g").agg(F.count("*").alias("c"), (F.sum("k") / F.count("*")).alias("mean")).where("c > 1")
    groups = groups.select("g", (F.col("c") > TILE).alias("wide"), "mean")
    later = sets.orderBy(F.desc("wide"), "mean", F.desc("g")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = under.join(groups, "g").withColumn("sent", F.sum("k").over(later)).where(F.col("sent") >= least)
    return written(kept.select("g", "m", "fp", "n"))


def _dealt(pairs: DataFrame, payload: DataFrame) -> DataFrame:
    """(u, t, member, fp, payload...) sorted so that a hub u comes before its partners.

    The payload of u is sent once for about `PARTNERS` of its partners, each
    partner's once per pair.  payload: (fp, ...) with one row per fp.
    """
    count = pairs.groupBy("u").agg(F.ceil(F.count("*") / PARTNERS).alias("c"))
    dealt = written(pairs.join(count, "u").select("u", "v", F.pmod(F.xxhash64("v"), F.col("c")).cast("int").alias("t")))
    work = dealt.select("u", "t").distinct().select("u", "t", F.col("u").alias("fp")).unionAll(dealt.select("u", "t", F.col("v").alias("fp")))
    rest = [c for c in payload.columns if c != "fp"]
    work = payload.join(F.broadcast(work) if dealt.count() <= BROADCAST_ROWS // 4 else work, "fp").select("u", "t", (F.col("fp") != F.col("u")).alias("member"), "fp", *rest)
    return work.repartition("u", "t").sortWithinPartitions("u", "t", "member")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (u, v) whose sets reach the threshold; `texts` has one (fp, text) of each.

    A task holds one set of u and one of v at a time.
    """

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            u, fp = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            left, right = [], []
            for row, values in shingle_sets(batch.column(4), width):
                if fp[row] == u[row]:
                    hub, own = u[row], values
                elif hub == u[row]:
                    both = len(np.intersect1d(own, values, assume_unique=True))
                    if 100 * both >= percent * (len(own) + len(values) - both):
                        left.append(u[row])
                        right.append(fp[row])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["u", "v"])

    return _dealt(pairs, texts).mapInArrow(compare, "u long, v long")


def _possible(m: np.ndarray, n: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sets behind rows of bitmaps x (sizes m) and y (sizes n) can reach the threshold; broadcasts."""
    apart = np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)
    # |a delta b| >= apart bounds the overlap by (m + n - apart) / 2
    return 100 * (m + n - apart) >= percent * (m + n + apart)


def _words(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint64).reshape(1, -1)


def plausible(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that the bitmaps don't rule out; maps: one (fp, n, bits) of each."""

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, size, own = None, 0, np.zeros((1, 0), dtype=np.uint64)
        for batch in batches:
            u, fp, n = (batch.column(c).to_pylist() for c in ("u", "fp", "n"))
            bits, keep = batch.column("bits"), []
            for row in range(batch.num_rows):
                words = _words(bits[row].as_py())
                if fp[row] == u[row]:
                    hub, size, own = u[row], n[row], words
                elif hub == u[row]:
                    w = min(own.shape[1], words.shape[1])
                    if _possible(size, n[row], folded(own, w), folded(words, w), percent)[0]:
                        keep.append(row)
            found = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([found.column("u"), found.column("fp")], names=["u", "v"])

    return _dealt(pairs, maps.select("fp", "n", "bits")).mapInArrow(compare, "u long, v long")


def _cross_pairs(component: np.ndarray, n: np.ndarray, allowed: Callable, maps: list[np.ndarray], leaders: bool, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, left out) of one tile: possible pairs of different components that `allowed(i, j)` lets pass.

    Only rows outside of the largest component are run against all rows, so a
    few strays beside a large group cost a multiple of their own number.  Rows
    are sorted by rank: with `leaders`, a row i goes on with its first possible
    partner, and is marked if it had others.
    """
    values, place, counts = np.unique(component, return_inverse=True, return_counts=True)
    if len(values) < 2:
        return
    stray = place != counts.argmax()
    sizes = np.array([m.shape[1] for m in maps])
    by_size = {int(s): np.flatnonzero(sizes == s) for s in np.unique(sizes)}
    stacked = {s: np.concatenate([maps[r] for r in rows]) for s, rows in by_size.items()}
    taken = np.zeros(len(n), dtype=bool)
    for a, rows in by_size.items():
        # sizes that can reach the threshold have bitmaps of the same width or one step apart
        for b in (a // 2, a, a * 2):
            if b not in by_size:
                continue
            w = min(a, b)
            at = np.flatnonzero(stray[rows])
            left, right = folded(stacked[a][at], w), folded(stacked[b], w)
            i, j = rows[at], by_size[b]
            step = max(1, BLOCK // len(j))
            for lo in range(0, len(i), step):
                x = i[lo : lo + step]
                fits = component[x, None] != component[None, j]
                fits &= ~stray[None, j] | (x[:, None] > j[None])
                fits &= 100 * np.minimum(n[x, None], n[None, j]) >= percent * np.maximum(n[x, None], n[None, j])
                fits &= allowed(x[:, None], j[None])
                p, q = np.nonzero(fits)
                keep = np.zeros(len(p), dtype=bool)
                some = max(1, BLOCK // w)
                for k in range(0, len(p), some):
                    u, v = p[k : k + some], q[k : k + some]
                    keep[k : k + some] = _possible(n[x[u]], n[j[v]], left[lo + u], right[v], percent)
                p, q = p[keep], q[keep]
                more = np.zeros(len(p), dtype=bool)
                if leaders and len(p):
                    p, first, times = np.unique(p, return_index=True, return_counts=True)
                    q, more = q[first], (times > 1) | taken[x[p]]
                    taken[x[p]] = True
                yield x[p], j[q], more


def _tile_pairs(rows: DataFrame, maps: DataFrame, leaders: bool, percent: int) -> DataFrame:
    """(g, u, v, more) of different components in a group that sizes and bitmaps don't rule out.

    rows: (g, fp, n, component), distinct; maps: one (fp, n, bits, share) of
    each.  With `leaders`, a document goes on with one partner of each bitmap
    width in a tile at most, the one with the largest share of common shingles; `more` marks those that had others.
    """
    base = float(np.log(100 / percent))
    rows = rows.withColumn("band", F.floor(F.ln(F.col("n").cast("double")) / base + 1e-9).cast("int"))
    bands = rows.groupBy("g", "band").agg(F.count("*").alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    # a row stays if another component has rows in its own or an adjacent band of the group
    near = bands.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    near = near.groupBy("g", "band").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo != hi").select("g", "band")
    rows = written(rows.join(near, ["g", "band"], "left_semi"))
    count = rows.groupBy("g").agg(F.count("*").alias("c"))
    rows = rows.join(count, "g")
    one = F.lit(0)
    small = rows.where(F.col("c") <= TILE).select("g", F.lit(-1).alias("b"), one.alias("i"), one.alias("j"), one.alias("own"), "fp", "component", "band")
    banded = rows.where(F.col("c") > TILE).select("g", "fp", "component", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("b"), "band")
    count = banded.groupBy("g", "b").agg(F.count("*").alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("band").alias("top"))
    count = count.where((F.col("lo") != F.col("hi")) & (F.col("top") == F.col("b"))).select("g", "b", F.ceil(F.col("c") / TILE).cast("int").alias("tiles"))
    large = banded.join(count, ["g", "b"]).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    large = large.select("g", "b", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp", "component", "band")
    keys = ["g", "b", "i", "j"]
    dealt = small.unionAll(large).join(maps.select("fp", "n", "bits", "share"), "fp").repartition(*keys).sortWithinPartitions(*keys, F.desc("share"), "fp")

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in group_runs(batches, keys):
            edges = group_starts(run, keys)
            column = {k: run.column(k).to_numpy(zero_copy_only=False) for k in (*keys, "own", "fp", "component", "n", "band")}
            raw = run.column("bits")
            for a, z in zip(edges[:-1], edges[1:], strict=True):
                at = {k: v[a:z] for k, v in column.items()}
                b, within, own, bands = at["b"][0], at["i"][0] == at["j"][0], at["own"], at["band"]

                def allowed(x, y, b=b, within=within, own=own, bands=bands):
                    # each pair once: under the higher band, and in one pair of tiles
                    ok = np.ones(np.broadcast_shapes(x.shape, y.shape), dtype=bool)
                    if b >= 0:
                        ok &= np.maximum(bands[x], bands[y]) == b
                    if not within:
                        ok &= own[x] != own[y]
                    return ok

                words = [_words(raw[int(r)].as_py()) for r in range(a, z)]
                for i, j, more in _cross_pairs(at["component"], at["n"], allowed, words, leaders, percent):
                    u, v = at["fp"][i], at["fp"][j]
                    out = [at["g"][i], np.minimum(u, v), np.maximum(u, v), more]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["g", "u", "v", "more"])

    return dealt.mapInArrow(compare, "g long, u long, v long, more boolean")


def _linked(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """((doc_id, h, fp, n) of each row, (node, component) of each set that has a link)."""
    bounded_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sig = written(signatures(docs, width, percent, _common_cells(docs, width)))

    own = sig.where("keys is not null")
    member = F.struct("share", "fp", "n")
    group = Window.partitionBy("key")
    # dealt before the window is set up, so that a row holds three numbers on its way
    rare = own.select(F.explode("keys").alias("key"), "fp", (F.col("n") * 256 + F.col("share")).alias("size")).repartition("key")
    rare = rare.select("key", "fp", F.shiftright("size", 8).alias("n"), F.col("size").bitwiseAND(255).cast("int").alias("share"))
    rare = rare.withColumn("lo", F.min("fp").over(group)).withColumn("hub", F.max(member).over(group)).withColumn("hi", F.max("fp").over(group)).where("lo != hi")
    # keys in common cells may be in any share of all rows: these are joined to aggregates only
    hot = own.select(F.explode("hot").alias("key"), "fp", "n", "share")
    hubs = hot.groupBy("key").agg(F.max(member).alias("hub"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo != hi").select("key", "hub")
    under = rare.select("hub", "fp", "n").unionAll(hot.join(hubs, "key").select("hub", "fp", "n"))
    # documents that meet under several shingles of one hub meet there once
    under = under.groupBy(F.col("hub.fp").alias("g"), F.col("hub.n").alias("m"), "fp", "n").agg(F.count("*").alias("k"))
    met = meetings(written(under), percent)
    under = met.where("g != fp")

    # one row of each set that meets others; any row of a set stands for it
    maps = KeyFilter(met.select("fp").distinct(), "fp").passing(own.select("doc_id", "h", "fp", "n", "share", "bits"), "fp")
    maps = written(maps.groupBy("fp").agg(*(F.first(c).alias(c) for c in ("n", "share", "bits")), F.max(F.struct("h", "doc_id")).alias("row")))

    def texts(pairs: DataFrame) -> DataFrame:
        need = pairs.select(F.col("u").alias("fp")).unionAll(pairs.select(F.col("v").alias("fp"))).distinct()
        need = maps.select("fp", "row.h", "row.doc_id").join(need, "fp").select("fp", "h", _key_of("doc_id", "h").alias("key"))
        need = written(need)
        found = KeyFilter(need, "key").passing(docs.select("text", F.xxhash64("text").alias("h"), "doc_id").withColumn("key", _key_of("doc_id", "h")), "key")
        # a text is shuffled once: what the join deals by is also what its copies are put together by
        found = found.select("key", "h", "text").join(need, ["key", "h"]).groupBy("key", "h", "fp").agg(F.first("text").alias("text"))
        return written(found.select("fp", "text"))

    near = 100 * F.least("m", "n") >= percent * F.greatest("m", "n")
    hubs = met.where("g = fp").select("g")
    pairs = under.where(near).join(hubs, "g", "left_semi").select(F.col("g").alias("u"), F.col("fp").alias("v"))
    known = written(plausible(pairs, maps, percent))
    links = written(verified(known, texts(known), width, percent))
    comp = written(components(links))

    # a hub has met all that share its shingles; the others of its group meet each other, if still apart
    for leaders in (True, False):
        rows = under.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select("g", "fp", "n", F.coalesce("component", "fp").alias("component"))
        tiles = written(_tile_pairs(rows, maps, leaders, percent))
        done = known.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        more = written(tiles.select("u", "v").distinct().join(done, ["u", "v"], "left_anti"))
        known = known.unionAll(more)
        if not more.isEmpty():
            links = written(links.unionAll(verified(more, texts(more), width, percent)))
            comp = written(components(links))
        again = tiles.where("more").select("g").distinct()
        if again.isEmpty():
            break
        under = under.join(again, "g", "left_semi")
    return sig.select("doc_id", "h", "fp", "n"), comp


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of `docs` (doc_id, text, ...).

    Words are runs of anything but ASCII white space, A-Z lower-cased.  Null
    and blank texts have no shingles and are components of their own; equal
    texts share a component.  Rows are the documents: a repeated doc_id gives
    one row per input row, each in its own text's component.  Rows without id
    have no component_id, but their texts link like others.  An empty table
    gives an empty result; other columns are ignored.  Very long texts are
    handled whole.
    """
    with temporary(docs.sparkSession):
        return written(_labelled(*_linked(docs, width, percent)), keep=True)


def _labelled(sig: DataFrame, comp: DataFrame) -> DataFrame:
    sets = sig.where("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    sets = sets.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = sets.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    label = sets.join(least, "component").select("fp", "component_id")
    out = sig.select("doc_id", "n", "fp").join(label, "fp", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """`docs` with one row left of each group of similar texts: the one with the least doc_id.

    Rows are the documents, so a doc_id that stands for two texts loses only
    the copies among them.  Rows without id come last, and rows of one id are
    taken in the order of their text's hash.  Null and blank texts are similar
    to nothing and stay; rows with equal doc_id and text count as one.  Extra
    columns are kept and an empty table stays empty.  Names
    that begin with tidemark_ are the operator's own.
    """
    with temporary(docs.sparkSession):
        sig, comp = _linked(docs, width, percent)
        marked = written(_marked(sig, comp).withColumn("key", _key_of("doc_id", "h")), keep=True)
        some = KeyFilter(marked, "key")
        # the keys that pass the filter and don't just go, found without texts
        stay = some.passing(sig.select("doc_id", "h").withColumn("key", _key_of("doc_id", "h")), "key").alias("s")
        gone = marked.where("rows = 0").alias("m")
        stay = stay.join(gone, F.expr("s.key = m.key and s.h = m.h and s.doc_id <=> m.doc_id"), "left_anti")
        few = KeyFilter(written(stay.select("key").distinct()), "key")
    marked = marked.select(F.col("doc_id").alias("tidemark_id"), F.col("h").alias("tidemark_m"), F.col("rows").alias("tidemark_rows"))
    names = docs.columns
    rows = docs.withColumn("tidemark_h", F.xxhash64("text")).withColumn("tidemark_key", _key_of("doc_id", "tidemark_h"))
    rows = some.marked(rows, "tidemark_key")
    # rows that the first filter clears stay where they are, however many others go; of these, only rows that may stay
    # after all are shuffled
    suspects = few.passing(rows.where("tidemark_maybe").drop("tidemark_maybe"), "tidemark_key")
    same = F.col("doc_id").eqNullSafe(F.col("tidemark_id")) & (F.col("tidemark_h") == F.col("tidemark_m"))
    left = written(suspects.join(marked, same, "left"))
    order = Window.partitionBy("tidemark_id", "tidemark_m").orderBy(F.xxhash64(*names))
    again = left.where("tidemark_rows > 1").withColumn("tidemark_row", F.row_number().over(order)).where("tidemark_row = 1")
    return rows.where("not tidemark_maybe").select(names).unionAll(left.where("tidemark_rows is null").select(names)).unionAll(again.select(names))


def _marked(sig: DataFrame, comp: DataFrame) -> DataFrame:
    """(doc_id, h, rows) of the texts that go (rows 0) and of those that repeat: all others pass where they are."""
    sets = sig.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    rows = written(sets.groupBy("doc_id", "h").agg(F.max("component").alias("component"), F.count("*").alias("rows")))
    best = rows.where("component is not null").groupBy("component").agg(F.min(rank).alias("best"))
    gone = rows.join(best, "component").where(~F.col("best").eqNullSafe(rank)).select("doc_id", "h", F.lit(0).alias("rows"))
    return rows.where("rows > 1").select("doc_id", "h", "rows").unionAll(gone).groupBy("doc_id", "h").agg(F.min("rows").alias("rows"))
