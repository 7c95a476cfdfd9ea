"""Minimum Euclidean distance from each point to an anchor set.

* ``min_dist_broadcast`` – anchors of a checked, bounded size (<= ``max_rows``)
  are shipped to every task; ``mapInPandas`` computes blocked distances with
  numpy on Arrow batches.
* ``min_dist_cells``     – anchors of any size. A binary tree of splits, chosen on a
  bounded number of hash-drawn anchors, deals all anchors to leaves of about
  ``LEAF_ROWS``; each leaf has the box of its anchors. A point is first measured
  against the leaf it falls into, which bounds its answer by a distance u; then only
  leaves whose box is nearer than u can hold something nearer, and the point is sent
  to those alone. Boxes are tested from the root down, so a point meets the boxes
  near it and not all of them, and a leaf's size does not grow with the anchors.
  Where only the ``k`` nearest points are wanted, the k-th least u bounds them all,
  so no point asks for a leaf beyond that either.
  Each (leaf, anchor chunk, point chunk) group is reduced with numpy inside
  ``cogroup.applyInPandas`` (pairs are never materialised as rows), and hot leaves
  are split into chunks so that no group exceeds about ``max_group`` anchors or
  points. Exact. Rows with a NULL or NaN feature have no distance: such anchors are
  nobody's nearest, such points have no row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.functions.buckets import log_bucket
from tripwire.session import materialize

BROADCAST_MAX_ROWS = 20_000


def _min_dist_np(q: np.ndarray, a: np.ndarray, q_block: int = 1024, a_block: int = 4096) -> np.ndarray:
    """Exact min_j ||q_i - a_j||.

    Candidates come from the BLAS form |q|^2 + |a|^2 - 2 q.a; every anchor whose
    approximate squared distance is within a tolerance (far above the rounding
    error of that form) of the approximate minimum is then re-measured by
    direct differences, so the result equals the direct computation.
    """
    out = np.full(len(q), np.inf)
    if len(a) == 0 or len(q) == 0:
        return np.sqrt(out)
    an = np.einsum("ij,ij->i", a, a)
    amax = float(an.max())
    for i in range(0, len(q), q_block):
        qb = q[i:i + q_block]
        qn = np.einsum("ij,ij->i", qb, qb)
        tol = 1e-9 * (qn + amax + 1.0)
        best = np.full(len(qb), np.inf)
        for j in range(0, len(a), a_block):
            d2 = qn[:, None] + an[None, j:j + a_block] - 2.0 * (qb @ a[j:j + a_block].T)
            best = np.minimum(best, d2.min(axis=1))
        exact = np.full(len(qb), np.inf)
        for j in range(0, len(a), a_block):
            ab = a[j:j + a_block]
            d2 = qn[:, None] + an[None, j:j + a_block] - 2.0 * (qb @ ab.T)
            iq, ia = np.nonzero(d2 <= (best + tol)[:, None])
            if len(iq):
                diff = qb[iq] - ab[ia]
                np.minimum.at(exact, iq, np.einsum("ij,ij->i", diff, diff))
        out[i:i + q_block] = exact
    return np.sqrt(out)


def _schema(df: DataFrame, key: str, out: str) -> T.StructType:
    return T.StructType([df.schema[key], T.StructField(out, T.DoubleType())])


def min_dist_broadcast(points: DataFrame, anchors: DataFrame, key: str, features: Sequence[str],
                       out: str = "min_dist", max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    feats = list(features)
    n = anchors.count()
    if n > max_rows:
        raise ValueError(f"{n} anchors exceed the broadcast bound {max_rows}; use min_dist_cells")
    a = np.array(anchors.select(*feats).collect(), dtype=float).reshape(n, len(feats))
    a_b = points.sparkSession.sparkContext.broadcast(a)

    def run(it):
        arr = a_b.value
        for pdf in it:
            q = pdf[feats].to_numpy(dtype=float)
            yield pd.DataFrame({key: pdf[key], out: _min_dist_np(q, arr)})

    return points.select(key, *feats).mapInPandas(run, _schema(points, key, out))


LEAF_ROWS = 2048            # anchors that a leaf of the split tree is made for
LEAF_SAMPLE, SAMPLE_MAX = 32, 1 << 18   # anchors drawn per leaf to choose the splits, and in all
PAIRS = 1 << 16             # (point, box) pairs that a task tests at a time


class _Boxes:
    """A binary tree of splits (``x[feature] < cut`` goes left) chosen on drawn anchors,
    and for each node the least and greatest value of every feature of its anchors."""

    def __init__(self, sample: np.ndarray, per_leaf: int):
        self.feature, self.cut, self.left, self.right, self.leaf = [], [], [], [], []
        todo = [(sample, -1, False)]
        while todo:
            x, parent, is_right = todo.pop()
            me = len(self.feature)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = me
            f, cut = self._split(x) if len(x) > per_leaf else (-1, 0.0)
            for part, value in ((self.feature, f), (self.cut, cut), (self.left, -1), (self.right, -1), (self.leaf, -1)):
                part.append(value)
            if f >= 0:
                low = x[:, f] < cut
                todo += [(x[~low], me, True), (x[low], me, False)]
        self.feature, self.cut, self.left, self.right = (np.array(a) for a in (self.feature, self.cut, self.left, self.right))
        ends = np.nonzero(self.feature < 0)[0]
        self.leaf = np.full(len(self.feature), -1)
        self.leaf[ends] = np.arange(len(ends))
        self.ends = ends

    @staticmethod
    def _split(x: np.ndarray) -> tuple[int, float]:
        """The feature of the widest middle 80 %, or of the widest range, cut at its median."""
        tenth = max(1, len(x) // 10)
        s = np.sort(x, axis=0)
        wide = s[-1 - tenth] - s[tenth]
        if wide.max() <= 0:
            wide = s[-1] - s[0]
        f = int(wide.argmax())
        col = s[:, f]
        if col[0] == col[-1]:
            return -1, 0.0
        cut = col[len(col) // 2]
        return f, float(cut if cut > col[0] else col[col > col[0]][0])

    def set_boxes(self, lo: np.ndarray, hi: np.ndarray) -> None:
        """Boxes of the leaves (lo > hi: empty); a parent's is made of its children's."""
        d = lo.shape[1]
        self.lo, self.hi = np.full((len(self.feature), d), np.inf), np.full((len(self.feature), d), -np.inf)
        self.lo[self.ends], self.hi[self.ends] = lo, hi
        for i in range(len(self.feature) - 1, -1, -1):      # children come after their parent
            if self.feature[i] >= 0:
                both = [self.left[i], self.right[i]]
                self.lo[i], self.hi[i] = self.lo[both].min(0), self.hi[both].max(0)

    def home(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row falls into."""
        at, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while len(rows):
            rows = rows[self.feature[at[rows]] >= 0]
            n = at[rows]
            at[rows] = np.where(x[rows, self.feature[n]] < self.cut[n], self.left[n], self.right[n])
        return self.leaf[at]

    def nearer(self, x: np.ndarray, u: np.ndarray, home: np.ndarray, most: float = np.inf):
        """Batches of (rows, leaves): leaves other than the home whose box is nearer than u, and not beyond ``most``."""
        limit = np.minimum(u, most) ** 2 * (1 + 1e-9)
        every = np.nonzero(u > 0)[0]
        todo = [(every[i:i + PAIRS], np.zeros(len(every[i:i + PAIRS]), dtype=np.int64)) for i in range(0, len(every), PAIRS)]
        while todo:
            q, n = todo.pop()
            gap = np.maximum(np.maximum(self.lo[n] - x[q], x[q] - self.hi[n]), 0.0)
            ok = np.einsum("ij,ij->i", gap, gap) <= limit[q]
            q, n = q[ok], n[ok]
            end = self.feature[n] < 0
            qe, leaf = q[end], self.leaf[n[end]]
            other = leaf != home[qe]
            if other.any():
                yield qe[other], leaf[other]
            q, n = np.tile(q[~end], 2), np.concatenate([self.left[n[~end]], self.right[n[~end]]])
            todo += [(q[i:i + PAIRS], n[i:i + PAIRS]) for i in range(0, len(q), PAIRS)]


def min_dist_cells(points: DataFrame, anchors: DataFrame, key: str, features: Sequence[str],
                   out: str = "min_dist", n_cells: int | None = None, max_group: int = 20_000,
                   seed: int = 42, k: int | None = None) -> DataFrame:
    """(key, out) of every point; with ``k``, of the k nearest points and of those that are
    no farther than a bound a little above the k-th distance, each with its exact distance."""
    feats = list(features)
    spark = points.sparkSession
    whole = ~F.greatest(*[F.col(f).isNull() | F.isnan(f) for f in feats], F.lit(False))
    doubles = [F.col(f).cast("double").alias(f) for f in feats]
    # repeated anchors cannot change a least distance: each is kept once, so equal rows make no hot leaf
    anchors = materialize(anchors.select(*doubles).filter(whole).distinct(), "anchors")
    n = anchors.count()
    leaves = max(1, n_cells or -(-n // LEAF_ROWS))
    want = min(n, leaves * LEAF_SAMPLE, SAMPLE_MAX)
    # the anchors with the least seeded hashes, about twice as many as wanted before the exact cut
    h = F.xxhash64(*feats, F.lit(seed))
    share = min(1.0, 2.0 * want / max(n, 1) + 1024.0 / max(n, 1))
    drawn = anchors.withColumn("_h", h).filter(F.col("_h") <= F.lit(-(1 << 63) + min(int(share * (1 << 64)), (1 << 64) - 1)))
    sample = np.array(drawn.orderBy("_h", *feats).limit(want).select(*feats).collect(), dtype=float).reshape(-1, len(feats))
    tree = _Boxes(sample, max(1, -(-len(sample) // leaves)))
    m = len(tree.ends)
    t_b = spark.sparkContext.broadcast(tree)

    def assign(it):
        t = t_b.value
        for pdf in it:
            yield pdf.assign(_leaf=t.home(pdf[feats].to_numpy(dtype=float)).astype("int32"))

    plain = [T.StructField(f, T.DoubleType()) for f in feats]
    leaf = T.StructField("_leaf", T.IntegerType())
    a_cells = materialize(anchors.mapInPandas(assign, T.StructType([*plain, leaf])), "anchor_leaves")
    stats = a_cells.groupBy("_leaf").agg(F.count(F.lit(1)).alias("n"), *[F.min(f).alias(f"lo_{f}") for f in feats],
                                         *[F.max(f).alias(f"hi_{f}") for f in feats]).collect()     # a row per leaf
    lo, hi, n_anchors = np.full((m, len(feats)), np.inf), np.full((m, len(feats)), -np.inf), {}
    for r in stats:
        lo[r["_leaf"]], hi[r["_leaf"]] = r[2:2 + len(feats)], r[2 + len(feats):]
        n_anchors[r["_leaf"]] = r["n"]
    tree.set_boxes(lo, hi)
    b_b = spark.sparkContext.broadcast(tree)
    point = [points.schema[key], *plain, leaf]

    def reduced(q_cells: DataFrame) -> DataFrame:
        """Least distances of the points to the anchors of their leaf; groups of at most about ``max_group``
        points and anchors. A leaf cut into several chunks gives a row per chunk of anchors, ``_a``."""
        counts = {r["_leaf"]: r["n"] for r in q_cells.groupBy("_leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
        plan = spark.createDataFrame([(i, -(-k // max_group), max(1, -(-counts.get(i, 0) // max_group))) for i, k in n_anchors.items()],
                                     "_leaf int, _ak int, _qk int")
        a_grp = (a_cells.join(F.broadcast(plan), "_leaf")
                 .withColumn("_a", F.pmod(F.xxhash64(*feats), F.col("_ak")).cast("int"))
                 .withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_qk") - 1))).select("_leaf", "_a", "_q", *feats))
        q_grp = (q_cells.join(F.broadcast(plan), "_leaf")
                 .withColumn("_q", F.pmod(F.xxhash64(F.col(key), *feats), F.col("_qk")).cast("int"))
                 .withColumn("_a", F.explode(F.sequence(F.lit(0), F.col("_ak") - 1))).select("_leaf", "_a", "_q", key, *feats))

        def reduce_group(qp: pd.DataFrame, ap: pd.DataFrame) -> pd.DataFrame:
            d = _min_dist_np(qp[feats].to_numpy(dtype=float), ap[feats].to_numpy(dtype=float))
            return qp[[key, *feats, "_leaf", "_a"]].assign(**{out: d})

        schema = T.StructType([*point, T.StructField("_a", T.IntegerType()), T.StructField(out, T.DoubleType())])
        return q_grp.groupBy("_leaf", "_a", "_q").cogroup(a_grp.groupBy("_leaf", "_a", "_q")).applyInPandas(reduce_group, schema)

    q_cells = points.select(key, *doubles).filter(whole)
    if not stats:
        return q_cells.limit(0).select(key, F.lit(0.0).alias(out))
    at_home = materialize(reduced(materialize(q_cells.mapInPandas(assign, T.StructType(point)), "point_leaves")), "home")
    most = np.inf if k is None else _kth_bound(at_home.groupBy(key).agg(F.min(out).alias(out)), out, k)

    def others(it):
        t = b_b.value
        for pdf in it:
            x = pdf[feats].to_numpy(dtype=float)
            for q, to in t.nearer(x, pdf[out].to_numpy(dtype=float), pdf["_leaf"].to_numpy(), most):
                yield pdf.iloc[q][[key, *feats]].assign(_leaf=to.astype("int32"))

    # any chunk of the home leaf bounds the answer; leaves that hold something nearer are asked next
    elsewhere = materialize(at_home.filter(F.col("_a") == 0).mapInPandas(others, T.StructType(point)), "others")
    found = at_home.select(key, out).unionByName(reduced(elsewhere).select(key, out))
    least = found.groupBy(key).agg(F.min(out).alias(out))
    return least if most == np.inf else least.filter(F.col(out) <= most)


def _kth_bound(df: DataFrame, col: str, k: int) -> float:
    """A value that at least k rows do not pass: the greatest of the ``log_bucket`` that holds
    the k-th least value (infinite if there are fewer); a row per bucket is collected."""
    buckets = df.groupBy(log_bucket(F.col(col)).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.max(col).alias("hi")).collect()
    seen = 0
    for r in sorted(buckets, key=lambda r: r["b"]):
        seen += r["n"]
        if seen >= k:
            return r["hi"]
    return np.inf
