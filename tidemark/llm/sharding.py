"""Size-tiered shards with a versioned manifest.

Arrivals are appended as small immutable files, straight from the tasks that
hold them.  Compaction looks at the sizes of the live files alone, whether
they were appended or merged before: files of one size tier are lined up and
cut into runs of about the target size, level by level, until no tier holds a
run worth merging.  Files of a run are then rewritten once, into the run's
final file; all others stay where they are.  A manifest version is a table of
the live files.  It is committed by renaming one small file, written whole
before, to the version's name, which fails if that exists: readers see the old
or the new version, and of two writers of one version the second starts anew
from the first one's.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidemark.llm.common import written

TARGET = 32 << 20
#: A tier is worth merging if it has so many files, or enough bytes for a target file.
FANOUT = 4
#: File rows that one task orders within a tier.
PLAN_ROWS = 100_000
LEVELS = 8
LIVE = "file string, bytes long, rows long, kind string, tier int, version int"


class Conflict(RuntimeError):
    """Another writer has committed the version."""


class Shards:
    """A folder of shards: `data/` with the files of each write, `manifest/` with the versions."""

    def __init__(self, spark: SparkSession, root: str, target: int = TARGET, fanout: int = FANOUT):
        self.spark, self.root, self.target, self.fanout = spark, root.rstrip("/"), target, fanout

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def versions(self) -> list[int]:
        """Committed versions, in order."""
        fs, path = self._fs(f"{self.root}/manifest")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())

    def _entry(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.root}/manifest/v{version}", wholetext=True).first()[0])

    def manifest(self, version: int | None = None) -> DataFrame:
        """(file, bytes, rows, kind, tier, version) of the live files of a version, the last one if none is given."""
        version = version or max(self.versions(), default=0)
        if not version:
            return self.spark.createDataFrame([], LIVE)
        return self.spark.read.schema(LIVE).parquet(self._entry(version)["table"])

    def tier(self, size) -> F.Column:
        """0 for files of at least half the target; each further tier is smaller by the fanout."""
        ratio = F.lit(self.target / 2) / F.greatest(size.cast("double"), F.lit(1.0))
        return F.greatest(F.ceil(F.log(float(self.fanout), ratio)), F.lit(0)).cast("int")

    def _files(self, path: str, kind: str, version: int) -> DataFrame:
        """The files of one write, as rows of a manifest."""
        fs, folder = self._fs(path)
        if not any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(folder)):
            return self.spark.createDataFrame([], LIVE)
        meta = self.spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        found = meta.groupBy("file", "bytes").agg(F.count("*").alias("rows"))
        return found.select("file", "bytes", "rows", F.lit(kind).alias("kind"), self.tier(F.col("bytes")).alias("tier"), F.lit(version).alias("version"))

    def append(self, rows: DataFrame, arrival: str) -> int:
        """Write `rows` as small files, apart for each value of the column `arrival`, and commit them; nothing is shuffled.

        A null arrival is one of its own.  Repeated rows stay repeated.  An
        empty table commits a version with no new file.  If another writer
        commits first, the files go into the version after it.
        """
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        named = rows.withColumn("tidemark_arrival", F.sha1(F.col(arrival).cast("string")))
        named.write.option("compression", "zstd").partitionBy("tidemark_arrival").parquet(path)
        while True:
            # the next number and what it builds on come from one listing, so a version is never based on an older one
            base = max(self.versions(), default=0)
            version = base + 1
            try:
                return self._commit(version, self.manifest(base).unionAll(self._files(path, "small", version)), rows.schema)
            except Conflict:
                continue

    def plan(self, version: int | None = None) -> DataFrame:
        """(file, rows, bytes, into) of the live files: the name of the merged file each one goes into; null if it stays."""
        files = written(self.manifest(version).select("file", "rows", "bytes", F.col("file").alias("into")), self.spark)
        lanes = max(1, -(-files.count() // PLAN_ROWS))
        for level in range(LEVELS):
            units = files.groupBy("into").agg(F.sum("bytes").alias("size"))
            units = units.withColumn("t", self.tier(F.col("size"))).withColumn("lane", F.pmod(F.xxhash64("into"), F.lit(lanes)))
            lane = Window.partitionBy("t", "lane")
            before = F.sum("size").over(lane.orderBy("into").rowsBetween(Window.unboundedPreceding, -1))
            units = units.withColumn("run", F.floor(F.coalesce(before, F.lit(0)) / self.target))
            run = Window.partitionBy("t", "lane", "run")
            units = units.withColumn("members", F.count("*").over(run)).withColumn("all", F.sum("size").over(run))
            merge = (F.col("t") > 0) & (F.col("members") > 1) & ((F.col("members") >= self.fanout) | (F.col("all") >= self.target / 2))
            units = units.withColumn("next", F.when(merge, F.concat_ws("-", F.lit(f"l{level}"), "t", "lane", "run")).otherwise(F.col("into")))
            step = files.join(units.select("into", "next"), "into").select("file", "rows", "bytes", F.col("next").alias("into"), (F.col("next") != F.col("into")).alias("moved"))
            step = written(step, self.spark)
            files = step.drop("moved")
            if step.where("moved").isEmpty():
                break
        return files.select("file", "rows", "bytes", F.when(F.col("into") != F.col("file"), F.sha1("into")).alias("into"))

    def compact(self) -> int:
        """Rewrite what the plan merges, commit the next version and return it.

        The last version is returned if nothing is worth merging, 0 if there
        is none.  Files that stay keep their paths.  Raises `Conflict` if
        another writer commits first; the files written for it are then in no
        version.
        """
        base = max(self.versions(), default=0)
        plan = self.plan(base)
        moves = written(plan.where("into is not null").select(F.col("file").alias("tidemark_file"), F.col("into").alias("tidemark_into")), self.spark)
        if moves.isEmpty():
            return base
        version = base + 1
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        merged = self._read(base, moves.select("tidemark_file")).withColumn("tidemark_file", F.col("_metadata.file_path"))
        merged = merged.join(moves, "tidemark_file").drop("tidemark_file")
        # one task writes one file, whose size is bounded by the target
        merged.repartition("tidemark_into").write.option("compression", "zstd").partitionBy("tidemark_into").parquet(path)
        live = self.manifest(base)
        kept = live.join(moves, live["file"] == moves["tidemark_file"], "left_anti")
        schema = StructType.fromJson(json.loads(self._entry(base)["schema"]))
        return self._commit(version, kept.unionAll(self._files(path, "merged", version)), schema)

    def _commit(self, version: int, live: DataFrame, schema: StructType) -> int:
        """Write the table of live files and the version's entry aside, then publish the entry under the version's name."""
        aside = uuid.uuid4().hex
        live.write.parquet(f"{self.root}/manifest/table-{aside}")
        fs, entry = self._fs(f"{self.root}/manifest/pending-{aside}")
        out = fs.create(entry, False)
        out.write(bytearray(json.dumps({"table": f"{self.root}/manifest/table-{aside}", "schema": schema.json()}).encode()))
        out.close()
        self._publish(entry, version)
        return version

    def _publish(self, entry, version: int) -> None:
        """Rename a whole entry to its version, which must not exist: readers never see a part of it, and one writer wins.

        The rename without overwriting is the one that Spark's streaming logs
        rely on; it is a single step on HDFS.
        """
        jvm = self.spark._jvm
        fs, path = self._fs(f"{self.root}/manifest/v{version}")
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(entry), fs.makeQualified(path), options)
        except Py4JJavaError as error:
            if fs.exists(path):
                fs.delete(entry, False)
                raise Conflict(f"manifest version {version} was committed by another writer") from error
            raise

    def _read(self, version: int, files: DataFrame) -> DataFrame:
        """The rows of some of a version's files, which are named to the reader: dead files are not opened."""
        schema = StructType.fromJson(json.loads(self._entry(version)["schema"]))
        paths = [r[0] for r in files.toLocalIterator()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def rows(self, columns: list[str], version: int | None = None) -> DataFrame:
        """`columns` of the rows in a version's live files, and `tidemark_shard`: struct(file, kind, tier, rows, bytes).

        Columns of any name may be asked for.  A version without files gives no rows.
        """
        version = version or max(self.versions())
        live = self.manifest(version)
        shard = F.struct("file", "kind", "tier", "rows", "bytes").alias("tidemark_shard")
        data = self._read(version, live.select("file"))
        if live.isEmpty():
            return data.select(*columns, F.lit(None).cast("struct<file:string,kind:string,tier:int,rows:bigint,bytes:bigint>").alias("tidemark_shard"))
        data = data.select(*columns, F.col("_metadata.file_path").alias("tidemark_file"))
        live = live.select(F.col("file").alias("tidemark_path"), shard)
        return data.join(live, F.col("tidemark_file") == F.col("tidemark_path")).select(*columns, "tidemark_shard")
