"""Helpers shared by the operators: tables in the shared folder, batch iteration,
and connected components.

Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir`` (through ``tripwire.session``), so a lost executor re-reads
files that every machine sees.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.session import ensure_checkpoint_dir

#: White space between words, as the contracts name it: space and U+0009 to U+000D.
SPACE_RE = r"[\x20\x09-\x0D]+"


_recorded: list[list[str]] = []


@contextmanager
def recording(paths: list[str]):
    """Add the scratch paths made inside to ``paths``, for whoever drops them later."""
    _recorded.append(paths)
    try:
        yield
    finally:
        _recorded.pop()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    for paths in _recorded:
        paths.append(path)
    return path


def write_once(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table in the shared folder; returns (table, path)."""
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path), path


def drop_path(spark: SparkSession, *paths: str) -> None:
    """Remove scratch tables that no later step reads."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, max_rounds: int = 60) -> tuple[DataFrame, list[str]]:
    """Connected components of undirected ``edges(a, b)`` (longs, a <> b).

    Alternates the large-star and small-star steps (Kiveris et al., 2014): every
    step relinks neighbours to the least neighbour, so a node with very many
    links is handled by a map-side combined ``min`` and a join that AQE can
    split, never gathered in one task. Each round is written to the shared
    folder. Returns ``(node, root)`` for every node with a link (root: least
    node of its component) and the paths to drop after use.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both if large else both.filter("v < u")
        least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        far = near.filter("v > u") if large else near
        out = far.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not large:  # the node itself is linked to its least neighbour too
            out = out.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    def mark(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 7L))")).first())

    cur, path = write_once(edges.select("a", "b").distinct(), "edges")
    seen = mark(cur)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        nxt, new_path = write_once(star(star(cur, True), False), "edges")
        drop_path(spark, path)
        cur, path, before = nxt, new_path, seen
        seen = mark(cur)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # now every edge is (node, root), root the least node
    roots = cur.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return roots.union(roots.select(F.col("root"), F.col("root"))).distinct(), [path]


# ---- rows looked up by the file group they lie in ------------------------------

def slim_rows(df: DataFrame, id_col: str, text_col: str, name: str) -> tuple[DataFrame, str]:
    """(row, id, raw): the texts in UTF-8 (null: empty), written once with a row
    key. The key's upper bits number the task that wrote the row, its group: a
    later scan finds what belongs to its rows in one small file per group
    (``write_sides``), so the texts themselves are never shuffled."""
    return write_once(df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8").alias("raw")), name)


def group_of(row: str = "row"):
    """Group of a row key: the part that ``monotonically_increasing_id`` gives the task."""
    return F.shiftright(F.col(row), 33).cast("int")


def write_sides(df: DataFrame, name: str, *order: str) -> str:
    """Write ``df`` (with a column ``g``) as one sorted file per group; returns the folder.
    A group belongs to the rows of one input task, so a file is bounded by that."""
    path = scratch_path(df.sparkSession, name)
    df.repartition("g").sortWithinPartitions("g", *order).write.partitionBy("g").parquet(path)
    return path


class Sides:
    """The side rows of one group at a time, read on the executors through
    ``pyarrow`` from the shared folder; column arrays, empty if it has none."""

    def __init__(self, path: str):
        self.path, self.group, self.table = path, None, {}

    def load(self, group: int, columns: list[str]) -> dict:
        if group != self.group:
            import pyarrow.parquet as pq
            from pyarrow import fs
            store, p = shared_fs(f"{self.path}/g={group}")
            found = store.get_file_info(fs.FileSelector(p, allow_not_found=True))
            parts = [pq.read_table(store.open_input_file(f.path), columns=columns) for f in sorted(found, key=lambda f: f.path) if f.path.endswith(".parquet")]
            self.group = group
            self.table = {c: np.concatenate([t.column(c).to_numpy() for t in parts]) if parts else np.empty(0, np.int64) for c in columns}
        return self.table


def shared_fs(path: str):
    """(pyarrow file system, path in it) of a path in the shared folder."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
