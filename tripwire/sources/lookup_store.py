"""A saved lookup that further placements register into (J4 on S5).

Each registration is a batch: a folder with its (row_hash, zone) rows and its
counters, which exists when it is renamed into ``batches``. Which registration of a
hash is the last is decided by (batch id, place of the zone in the caller's order),
not by the time of the commit, so batches may arrive in any order and more than
once. ``compact`` folds batches into a new base; a reader takes the newest base
and the batches that it does not name.

Only hashes, zone names and counts are written: no raw values, no salt.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.schema import ZONES

ROWS = "row_hash string, batch long, place int, zone string"
COUNTS = "zone string, n_registered long"


class LookupStore:
    """A lookup under ``path``, a folder that all machines share."""

    def __init__(self, spark: SparkSession, path: str, order: Sequence[str] = tuple(ZONES)):
        self.spark, self.path, self.order = spark, path.rstrip("/"), list(order)
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        root = self._path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(root)) if self._fs.exists(root) else []

    def batches(self) -> list[int]:
        """Ids of the committed batches, compacted ones included."""
        return sorted(int(n.split("=")[1]) for n in self._names("batches"))

    def _place(self, made: str, folder: str, name: str) -> bool:
        """Rename a finished folder into place; False if another writer was first. A
        rename onto an existing folder moves into it on some file systems, so the
        folder's own marker is looked for afterwards."""
        target, marker = self._path(f"{self.path}/{folder}/{name}"), f"{self.path}/{folder}/{name}/by-{made.rsplit('-', 1)[1]}"
        self._fs.mkdirs(target.getParent())
        self._fs.mkdirs(self._path(f"{made}/by-{made.rsplit('-', 1)[1]}"))
        if not self._fs.exists(target) and self._fs.rename(self._path(made), target) and self._fs.exists(self._path(marker)):
            return True
        for lost in (made, f"{self.path}/{folder}/{name}/{made.rsplit('/', 1)[1]}"):
            self._fs.delete(self._path(lost), True)
        return False

    def register(self, batch: int, decoys: DataFrame, hash_col: str = "row_hash", zone_col: str = "zone") -> bool:
        """Register ``decoys`` as batch ``batch``; False if that id is committed already.

        Rows without a hash are ignored; of several zones of a hash the last in the
        store's order wins, other names after it by the alphabet, NULL before all.
        The counters count registrations, repeated ones too."""
        if batch in self.batches():
            return False
        z = F.col("zone")
        rows = decoys.select(F.col(hash_col).alias("row_hash"), F.col(zone_col).alias("zone")).filter("row_hash IS NOT NULL")
        at = F.array_position(F.array(*[F.lit(o) for o in self.order]), z).cast("int") if self.order else F.lit(0)
        place = F.when(z.isNull(), F.lit(0)).when(at > 0, at).otherwise(F.lit(len(self.order) + 1))
        made = f"{self.path}/unfinished/{batch}-{uuid.uuid4().hex}"
        rows.groupBy("row_hash").agg(F.max(F.struct(place.alias("place"), "zone")).alias("w")) \
            .select("row_hash", F.lit(batch).cast("long").alias("batch"), "w.place", "w.zone").write.parquet(f"{made}/rows")
        rows.groupBy("zone").agg(F.count(F.lit(1)).alias("n_registered")).write.parquet(f"{made}/counts")
        return self._place(made, "batches", f"batch={batch}")

    def _sources(self) -> tuple[list[str], list[int]]:
        """The folders to read, and the batch ids in the newest base."""
        found = self.batches()
        bases = self._names("bases")
        done = [] if not bases else [r.batch for r in self.spark.read.schema("batch long").parquet(f"{self.path}/bases/{bases[-1]}/of").collect()]
        return [f"{self.path}/bases/{b}" for b in bases[-1:]] + [f"{self.path}/batches/batch={b}" for b in found if b not in set(done)], done

    def _read(self, kind: str, schema: str) -> DataFrame:
        folders, _ = self._sources()
        return self.spark.read.schema(schema).parquet(*[f"{f}/{kind}" for f in folders]) if folders else self.spark.createDataFrame([], schema)

    def _latest(self) -> DataFrame:
        return self._read("rows", ROWS).groupBy("row_hash").agg(F.max(F.struct("batch", "place", "zone")).alias("w")) \
            .select("row_hash", "w.batch", "w.place", "w.zone")

    def lookup(self) -> DataFrame:
        """(row_hash, zone): the last registration of every hash; one map-side combined aggregate."""
        return self._latest().select("row_hash", "zone")

    def summary(self) -> DataFrame:
        """J7 over all batches: (zone, n_registered, n_hashes)."""
        counts = self._read("counts", COUNTS).groupBy("zone").agg(F.sum("n_registered").alias("n_registered"))
        held = self.lookup().groupBy("zone").agg(F.count(F.lit(1)).alias("n_hashes")).withColumnRenamed("zone", "held")
        return counts.join(held, F.col("zone").eqNullSafe(F.col("held")), "left").select("zone", "n_registered", F.coalesce("n_hashes", F.lit(0)).cast("bigint").alias("n_hashes"))

    def compact(self) -> bool:
        """Fold the newest base and all batches into a new base; batches that commit
        meanwhile, or later with a smaller id, are read beside it. Bases are numbered,
        so of two writers one wins and the other changes nothing."""
        found, bases = self.batches(), self._names("bases")
        _, done = self._sources()
        if set(found) <= set(done):
            return False
        made = f"{self.path}/unfinished/base-{uuid.uuid4().hex}"
        self._latest().write.parquet(f"{made}/rows")
        self._read("counts", COUNTS).groupBy("zone").agg(F.sum("n_registered").alias("n_registered")).write.parquet(f"{made}/counts")
        self.spark.createDataFrame([(b,) for b in found], "batch long").coalesce(1).write.parquet(f"{made}/of")
        return self._place(made, "bases", f"base={int(bases[-1].split('=')[1]) + 1 if bases else 1:09d}")
