"""Models: random forest, k-means, isolation forest, baselines.

Random forest and k-means are Spark ML. Spark ML has no isolation forest, so
it is built here as a distributed operator:

* fit  – every tree draws its own sub-sample of ``psi`` rows by seeded hash:
  a row survives for tree t when u(key, t) < c·psi/n (a filter inside one
  projection, no row replication beyond the survivors), then each tree's
  candidates (~c·psi rows, bounded) are reduced to exactly ``psi`` rows and the
  tree is grown in ``groupBy(tree).applyInPandas``. The output is a node table.
* score – the node table (trees x <= 2·psi nodes, bounded) is broadcast and
  ``mapInPandas`` walks all trees for a whole Arrow batch with numpy.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.operators.ranking import scalar

EULER = 0.5772156649015329


# ---- Spark ML wrappers -----------------------------------------------------------

def _assemble(df: DataFrame, features: Sequence[str], out: str = "_features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def fit_input(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Assembled, materialised training rows: iterative fits read them many
    times and must not recompute the upstream lineage on each pass."""
    from tripwire.session import materialize
    return materialize(_assemble(df.select(*keep, *features), features).select(*keep, "_features"))


#: Rows from which rows are dealt evenly over the tasks, and a forest is fitted over blocks.
EVEN_ROWS = 1 << 17


def even_rows(rows: DataFrame) -> DataFrame:
    """The rows of a written table in parts of one size: its files follow those of the
    source and may differ much, and a job waits for the largest. Small tables stay as they
    are, and so do those whose largest part is at most half above a core's share."""
    from tripwire.session import materialize
    parts = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]    # a row per part
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if sum(parts) < EVEN_ROWS or max(parts) <= 1.5 * sum(parts) / cores:
        return rows
    return materialize(rows.repartition(cores * -(-rows.rdd.getNumPartitions() // cores)), "even")  # whole rounds of tasks


#: (row, tree) pairs up to which a forest keeps the node that a row has reached; more would leave the memory.
NODE_IDS = 1 << 30


def class_sizes(df: DataFrame, label: str, weight_col: str | None = None) -> tuple[int, tuple[float, float]] | None:
    """(rows, weight of class 0 and of class 1), or None if a label is not 0 or 1 or a
    class has more than one weight."""
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    y = F.col(label).cast("double")
    per = df.groupBy(F.when(y.isin(0.0, 1.0), y.cast("int")).alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.min(w).alias("lo"), F.max(w).alias("hi"), F.count(w).alias("m")).collect()   # <= 3 rows
    if not per or any(r["y"] is None or r["m"] < r["n"] or r["lo"] != r["hi"] for r in per):
        return None
    known = {r["y"]: r["lo"] for r in per}
    return sum(r["n"] for r in per), (known.get(0, 1.0), known.get(1, 1.0))


def fit_random_forest(df: DataFrame, features: Sequence[str], label: str, num_trees: int = 100,
                      max_depth: int = 10, seed: int = 42, weight_col: str | None = None):
    """M2: random forest (sqrt feature subsets, like the reference); Spark ML's, or from
    ``EVEN_ROWS`` rows on the same forest over blocks of binned rows (``forest.fit_blocks``)
    for a 0/1 label with one weight per class.

    Of Spark ML's, up to ``NODE_IDS`` (row, tree) pairs the node of each row in each tree is kept
    from level to level, so rows do not walk every tree from its root again; the
    forest is the same either way."""
    from pyspark.ml.classification import RandomForestClassifier
    known = class_sizes(df, label, weight_col)
    if known and known[0] >= EVEN_ROWS:
        from tripwire.operators.forest import fit_blocks
        return fit_blocks(df, features, label, *known, num_trees, max_depth, seed)
    rf = RandomForestClassifier(featuresCol="_features", labelCol=label, numTrees=num_trees,
                                maxDepth=max_depth, seed=seed, featureSubsetStrategy="sqrt")
    if weight_col:
        rf = rf.setWeightCol(weight_col)
    keep = [label] + ([weight_col] if weight_col else [])
    rows = even_rows(fit_input(df.withColumn(label, F.col(label).cast("double")), features, keep))
    # no checkpoints of the kept nodes: the lineage is as long as the trees are deep
    return rf.setCacheNodeIds(rows.count() * num_trees <= NODE_IDS).setCheckpointInterval(-1).fit(rows)


def positive_proba(model, df: DataFrame, features: Sequence[str], out: str = "proba") -> DataFrame:
    """P(class 1) and the 0/1 prediction next to the input columns."""
    from tripwire.operators.forest import BlockForest
    if isinstance(model, BlockForest):
        return model.score(df, features, out)
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(_assemble(df, features))
    return (scored.withColumn(out, vector_to_array("probability")[1])
            .withColumn("pred", F.col("prediction").cast("int"))
            .drop("_features", "rawPrediction", "probability", "prediction"))


def fit_kmeans(df: DataFrame, features: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """K-means centroids as a small DataFrame with the feature columns."""
    from pyspark.ml.clustering import KMeans
    model = KMeans(k=k, seed=seed, featuresCol="_features").fit(fit_input(df, features))
    rows = [tuple(float(x) for x in c) for c in model.clusterCenters()]
    schema = T.StructType([T.StructField(f, T.DoubleType()) for f in features])
    return df.sparkSession.createDataFrame(rows, schema)


# ---- isolation forest (M6-M8) --------------------------------------------------------

def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("split", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType()), T.StructField("depth", T.IntegerType()),
])


def _grow(tree: int, x: np.ndarray, seed: int, height_limit: int) -> list[tuple]:
    rng = np.random.default_rng([seed, tree])
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([tree, me, -1, 0.0, -1, -1, int(len(idx)), depth])
        if depth >= height_limit or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(0), sub.max(0)
        usable = np.nonzero(hi > lo)[0]
        if len(usable) == 0:
            return me
        f = int(rng.choice(usable))
        s = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < s
        left = build(idx[go_left], depth + 1)
        right = build(idx[~go_left], depth + 1)
        nodes[me][2:6] = [f, s, left, right]
        return me

    build(np.arange(len(x)), 0)
    return [tuple(n) for n in nodes]


def fit_isolation_forest(df: DataFrame, features: Sequence[str], key: str, n_trees: int = 100,
                         psi: int = 256, seed: int = 42, oversample: float = 4.0) -> DataFrame:
    """M6: node table of ``n_trees`` isolation trees, each on exactly
    min(psi, n) rows drawn without replacement by seeded hash."""
    feats = list(features)
    n = scalar(df.select(F.count(F.lit(1))))
    m = min(psi, n)
    thr = min(1.0, oversample * m / max(n, 1) + 64.0 / max(n, 1))
    height = max(1, math.ceil(math.log2(max(m, 2))))
    base = df.select(key, *[F.col(f).cast("double") for f in feats])
    # every tree draws on its own at every table size: a 64-bit hash of (key, tree) under a threshold
    draw = lambda t: F.xxhash64(F.col(key), F.lit(seed), t)
    limit = F.lit(-(1 << 63) + min(int(thr * (1 << 64)), (1 << 64) - 1)).cast("bigint")
    trees = F.sequence(F.lit(1), F.lit(n_trees))
    cand = (base.withColumn("tree", F.explode(F.filter(trees, lambda t: draw(t) <= limit)))
            .withColumn("_u", draw(F.col("tree"))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        take = pdf.sort_values(["_u", key]).head(m)
        if len(take) < m and n > len(take):
            raise RuntimeError(f"tree {t}: {len(take)} candidates < {m}; raise oversample")
        return pd.DataFrame(_grow(t, take[feats].to_numpy(dtype=float), seed, height),
                            columns=[f.name for f in NODE_SCHEMA.fields])

    return cand.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).withColumn("psi", F.lit(m))


def score_isolation_forest(df: DataFrame, forest: DataFrame, features: Sequence[str], key: str,
                           out: str = "anomaly_score") -> DataFrame:
    """M7: anomaly score 2^(-E[h(x)] / c(psi)) (higher = more anomalous)."""
    feats = list(features)
    pdf = forest.toPandas()            # n_trees x <= 2*psi nodes: bounded
    psi = int(pdf["psi"].iloc[0])
    trees = []
    for _, g in pdf.sort_values(["tree", "node"]).groupby("tree"):
        adj = np.array([_c(s) for s in g["size"]], dtype=float)
        trees.append((g["feature"].to_numpy(), g["split"].to_numpy(), g["left"].to_numpy(),
                      g["right"].to_numpy(), g["depth"].to_numpy(dtype=float) + adj))
    b = df.sparkSession.sparkContext.broadcast((trees, _c(psi)))

    def run(it):
        ts, cpsi = b.value
        for part in it:
            x = part[feats].to_numpy(dtype=float)
            total = np.zeros(len(x))
            rows = np.arange(len(x))
            for feat, split, left, right, leafval in ts:
                node = np.zeros(len(x), dtype=np.int64)
                active = feat[node] >= 0
                while active.any():
                    ai = rows[active]
                    f = feat[node[ai]]
                    go_left = x[ai, f] < split[node[ai]]
                    node[ai] = np.where(go_left, left[node[ai]], right[node[ai]])
                    active = feat[node] >= 0
                total += leafval[node]
            score = np.power(2.0, -(total / len(ts)) / cpsi) if cpsi > 0 else np.full(len(x), 0.5)
            yield pd.DataFrame({key: part[key], out: score})

    schema = T.StructType([df.schema[key], T.StructField(out, T.DoubleType())])
    return df.select(key, *feats).mapInPandas(run, schema)


def contamination_threshold(scores: DataFrame, contamination: float, col: str = "anomaly_score") -> float:
    """M8: score above which the top ``contamination`` share lies (exact percentile)."""
    from tripwire.operators.cumulative import exact_percentile
    return exact_percentile(scores, col, 1.0 - contamination)


def flag_outliers(scores: DataFrame, threshold: float, col: str = "anomaly_score",
                  out: str = "is_outlier") -> DataFrame:
    return scores.withColumn(out, F.col(col) > F.lit(threshold))


# ---- baselines (M2-M5, M9) -------------------------------------------------------------

def evaluate_scores(scored: DataFrame, label: str, score: str, pred: str, name: str) -> DataFrame:
    """One baseline row: label + AUC-ROC, AUC-PR (AP), F1, precision, recall."""
    from tripwire.operators import metrics
    from tripwire.session import materialize
    # three metrics read the scored rows, so they are scored and written once
    s = materialize(scored.select(F.col(label).alias("label"), F.col(score).alias("score"), F.col(pred).alias("pred")), "scored")
    auc = metrics.auc_roc(s).first()["auc_roc"]
    ap = metrics.average_precision(s).first()["average_precision"]
    bm = metrics.binary_metrics(s).first()
    return scored.sparkSession.createDataFrame(
        [(name, auc, ap, bm["f1"], bm["precision"], bm["recall"])],
        "label string, auc_roc double, auc_pr double, f1 double, precision double, recall double")


def baseline_random_forest(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                           name: str, num_trees: int = 100, max_depth: int = 10, seed: int = 42) -> DataFrame:
    """M2 with balanced class weights (M1); evaluated on the clean test rows."""
    from tripwire.operators.metrics import with_weights
    model = fit_random_forest(with_weights(train, label, "_w"), features, label, num_trees, max_depth,
                              seed, weight_col="_w")
    scored = positive_proba(model, test, features, out="_p")
    return evaluate_scores(scored, label, "_p", "pred", name)


def baseline_isolation_forest(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                              key: str, name: str = "Isolation Forest", contamination: float = 0.035,
                              n_trees: int = 100, seed: int = 42) -> DataFrame:
    from tripwire.session import materialize
    forest = materialize(fit_isolation_forest(train, features, key, n_trees, seed=seed), "if_nodes")
    thr = contamination_threshold(score_isolation_forest(train, forest, features, key), contamination)
    s = score_isolation_forest(test, forest, features, key)
    scored = (test.select(key, label).join(s, key)
              .withColumn("pred", (F.col("anomaly_score") > F.lit(thr)).cast("int")))
    return evaluate_scores(scored, label, "anomaly_score", "pred", name)


def paired_forest_scores(clean: DataFrame, injected: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                         key: str, num_trees: int = 100, max_depth: int = 10, seed: int = 42) -> DataFrame:
    """Class-weighted forests fitted on the clean and on the injected training
    rows, both scoring the same test rows: (key, label, score_clean, score_injected),
    written once. ``metrics.paired_auc`` compares them."""
    from tripwire.operators.metrics import with_weights
    from tripwire.session import materialize
    scored = test.select(key, label, *features)
    for rows, out in ((clean, "score_clean"), (injected, "score_injected")):
        model = fit_random_forest(with_weights(rows, label, "_w"), features, label, num_trees, max_depth, seed, weight_col="_w")
        scored = positive_proba(model, scored, features, out=out).drop("pred")
    return materialize(scored.select(key, label, "score_clean", "score_injected"), "paired")
