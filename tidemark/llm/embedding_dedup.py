"""Near-duplicate embeddings by p-stable hashing and exact cosine checks.

Normalised vectors are projected on Gaussian directions; each table quantises
`projections` of them, shifted at random, into one bucket.  Vectors of one
label that share a bucket in any of the `tables` are compared by exact cosine
in double precision.  Equal vectors are compared once as one class.  Buckets
of any size are cut into tiles, and each pair of tiles is one group of rows,
so no task holds more than two tiles; a pair is counted in the first table in
which it meets, so nothing has to be collected to remove repeats.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import group_runs, group_starts, tidy, written
from tidemark.llm.components import components

PROJECTIONS = 5
#: Unrelated vectors that one may meet in a table, and the chance to miss a pair at the threshold.
STRANGERS = 64
MISS = 1.2e-5
WIDTH = 0.9
TILE = 512
SEED = 7


def _directions(dim: int, tables: int, projections: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED + dim)
    return rng.standard_normal((dim, tables * projections)), rng.random(tables * projections) * WIDTH


def bucket_keys(unit: np.ndarray, tables: int, projections: int) -> np.ndarray:
    """(rows, tables) 64-bit bucket keys of unit vectors."""
    along, shift = _directions(unit.shape[1], tables, projections)
    # row by row, so that a vector's key never depends on what stands beside it
    cells = np.floor((np.stack([u @ along for u in unit]) + shift) / WIDTH).astype(np.int64).reshape(len(unit), tables, projections)
    key = np.full((len(unit), tables), 1469598103934665603, dtype=np.uint64)
    for i in range(projections):
        key = (key ^ cells[:, :, i].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _unit(value) -> np.ndarray | None:
    """The vector scaled to length one in double precision, or None."""
    if value is None or not len(value) or any(x is None for x in value):
        return None
    v = np.asarray(value, dtype=np.float64)
    top = np.abs(v).max()
    if not np.isfinite(v).all() or top == 0:
        return None
    v = v / top
    return v / np.sqrt(v @ v)


def _local_links(p: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
    """The least position that each of n points reaches over the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[p], root[q])
        new = root.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _meeting(distance: float) -> float:
    """Chance that two points at this distance share a cell of one projection."""
    r = WIDTH / distance
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def shape(rows: int, cosine: float) -> tuple[int, int]:
    """(projections, tables) for so many vectors.

    More vectors need more projections, so that a vector meets at most
    STRANGERS unrelated ones a table however many there are; more projections
    need more tables, so that a pair at the threshold is missed with a chance
    of MISS at most.
    """
    near, far = _meeting(math.sqrt(2 - 2 * cosine)), _meeting(math.sqrt(2))
    projections = max(PROJECTIONS, math.ceil(math.log(max(1.0, rows / STRANGERS)) / -math.log(far)))
    return projections, math.ceil(math.log(MISS) / math.log1p(-(near**projections)))


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, tables: int | None = None, projections: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of vectors (vec_id, embedding, label).

    Tables and projections follow from the number of rows unless both are given.

    Null, empty, zero and non-finite vectors, vectors with null parts, and rows
    with a null label link with nothing; vectors of different length never
    link.  Repeated rows are vectors of their own with the same vec_id.
    Other columns are ignored.
    """
    rows = vectors.select("vec_id", "embedding", "label", F.xxhash64("label", "embedding").alias("h1"), F.xxhash64("embedding", F.lit(1), "label").alias("h2"))
    # a hash skips null parts, so vectors that have any must not enter a class
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("label").isNotNull() & F.forall("embedding", real) & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    if projections is None or tables is None:
        projections, tables = shape(vectors.count(), cosine)
    classes = rows.where("usable").groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.min("vec_id").alias("vec_id"), F.first(F.struct("label", "embedding")).alias("v"))

    @tidy
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2, group, units = [], [], [], []
            for i, v in enumerate(batch.column(3).to_pylist()):
                u = _unit(v["embedding"])
                if u is not None:
                    h1.append(batch.column(0)[i].as_py())
                    h2.append(batch.column(1)[i].as_py())
                    group.append(f"{len(u)}:{v['label']}")
                    units.append(u)
            keys: list = [None] * len(units)
            by_dim: dict[int, list[int]] = {}
            for i, u in enumerate(units):
                by_dim.setdefault(len(u), []).append(i)
            for at in by_dim.values():
                for i, k in zip(at, bucket_keys(np.stack([units[i] for i in at]), tables, projections), strict=True):
                    keys[i] = k
            out = [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), batch.column(2).take(pa.array([], pa.int64())), pa.array(group, pa.string()), pa.array(keys, pa.list_(pa.int64())), pa.array([u.tobytes() for u in units], pa.binary())]
            keep = [i for i, v in enumerate(batch.column(3).to_pylist()) if _unit(v["embedding"]) is not None]
            out[2] = batch.column(2).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(out, names=["h1", "h2", "copies", "part", "keys", "unit"])

    units = classes.select("h1", "h2", "copies", "v").mapInArrow(hashes, "h1 long, h2 long, copies long, part string, keys array<long>, unit binary")
    units = written(units.withColumn("node", F.xxhash64("h1", "h2")))

    meets = units.select("node", "part", F.posexplode("keys").alias("tab", "key"))
    meets = meets.select("node", F.xxhash64("part", "tab", "key").alias("bucket"), F.col("tab").cast("int").alias("tab"))
    full = meets.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket", F.ceil(F.col("m") / TILE).cast("int").alias("tiles"))
    dealt = meets.join(full, "bucket").withColumn("own", F.pmod("node", F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("bucket", "tab", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node")
    keys = ["bucket", "i", "j"]
    dealt = dealt.join(units.select("node", "copies", "keys", "unit"), "node").repartition(*keys).sortWithinPartitions(*keys)

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in group_runs(batches, keys):
            edges = group_starts(run, keys)
            node = run.column("node").to_numpy()
            own, i, j = (run.column(k).to_numpy() for k in ("own", "i", "j"))
            tab, copies = run.column("tab").to_numpy(), run.column("copies").to_numpy()
            unit, key = run.column("unit"), run.column("keys")
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for a, z in zip(edges[:-1], edges[1:], strict=True):
                if z - a < 2:
                    continue
                v = np.stack([np.frombuffer(unit[int(x)].as_py(), dtype=np.float64) for x in range(a, z)])
                k = np.stack([key[int(x)].values.to_numpy() for x in range(a, z)])
                p, q = np.nonzero(np.triu(v @ v.T >= cosine, 1))
                if i[a] != j[a]:
                    cross = own[a + p] != own[a + q]
                    p, q = p[cross], q[cross]
                lo = 1 << 16
                first = np.concatenate([(k[p[s : s + lo]] == k[q[s : s + lo]]).argmax(axis=1) for s in range(0, len(p), lo)] or [p])
                p, q = p[first == tab[a]], q[first == tab[a]]
                if not len(p):
                    continue
                links = np.zeros(z - a, dtype=np.int64)
                np.add.at(links, p, copies[a + q])
                np.add.at(links, q, copies[a + p])
                some = np.flatnonzero(links)
                out.append((node[a + some], links[some], node[a + _local_links(p, q, z - a)[some]]))
            columns = [np.concatenate([x[c] for x in out]) if out else np.zeros(0, dtype=np.int64) for c in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "peer"])

    found = written(dealt.mapInArrow(compare, "node long, links long, peer long"))
    comp = components(found.select(F.col("node").alias("u"), F.col("peer").alias("v")))

    base = classes.select("h1", "h2", "copies", "vec_id", F.xxhash64("h1", "h2").alias("node"))
    base = base.join(units.select("node", F.lit(True).alias("good")), "node", "left").join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(comp, "node", "left")
    base = written(base.withColumn("component", F.coalesce("component", "node")))
    least = base.where("good").groupBy("component").agg(F.min("vec_id").alias("least"))
    label = base.where("good").join(least, "component").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("least"))
    out = rows.join(label, ["h1", "h2"], "left")
    out = out.select("vec_id", F.when(F.col("usable"), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"), F.when(F.col("usable"), F.coalesce("least", "vec_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
