"""Decoy synthesis: PCA + Gaussian mixture and a latent-Gaussian generator.

Model fits are Spark ML over the real rows (PCA, the start of the mixture) and EM
steps over blocks of rows; their parameters are bounded (d x k, k x k per component) and become literals.
Drawing n decoys is ``spark.range(n)`` plus column arithmetic: a component
from the cumulative weights, standard normals by Box-Muller from seeded md5
uniforms of (id, seed, slot), then mu + L·eps and the inverse projection. No
row passes through the driver and every draw is reproducible per id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.functions.draws import standard_normal, uniform01
from tripwire.operators import nearest, prep
from tripwire.operators.cumulative import exact_percentile
from tripwire.operators.ranking import first_n, scalar
from tripwire.schema import DISCRIMINATOR_PASS, FEATURES, FLAG_COLUMNS, TYPE_COLUMNS
from tripwire.session import materialize

ID = "decoy_id"


@dataclass
class Projection:
    """G1 parameters: feature means and the d x k principal axes."""
    features: list[str]
    mean: np.ndarray
    axes: np.ndarray            # d x k

    @property
    def k(self) -> int:
        return self.axes.shape[1]


def _lin(coefs: Sequence[float], cols: Sequence[Column], const: float = 0.0) -> Column:
    expr = F.lit(float(const))
    for c, x in zip(coefs, cols):
        if c != 0.0:
            expr = expr + F.lit(float(c)) * x
    return expr


def fit_pca(real: DataFrame, features: Sequence[str] = FEATURES, k: int = 10) -> Projection:
    """G1: PCA to min(k, d) components on mean-centred rows (Spark ML PCA)."""
    from pyspark.ml.feature import PCA
    from tripwire.operators.models import fit_input
    feats = list(features)
    mean = np.array(real.agg(*[F.avg(f) for f in feats]).first(), dtype=float)
    centred = real.select(*[(F.col(f) - F.lit(m)).alias(f) for f, m in zip(feats, mean)])
    model = PCA(k=min(k, len(feats)), inputCol="_features", outputCol="_z").fit(fit_input(centred, feats))
    return Projection(feats, mean, model.pc.toArray())


def project(df: DataFrame, p: Projection, keep: Sequence[str] = ()) -> DataFrame:
    """G1 transform: z_j = (x - mean) . axis_j."""
    cen = [F.col(f) - F.lit(float(m)) for f, m in zip(p.features, p.mean)]
    return df.select(*keep, *[_lin(p.axes[:, j], cen).alias(f"z{j}") for j in range(p.k)])


def inverse(z: DataFrame, p: Projection, keep: Sequence[str] = (ID,)) -> DataFrame:
    """x = z . axes^T + mean."""
    zc = [F.col(f"z{j}") for j in range(p.k)]
    return z.select(*keep, *[_lin(p.axes[i, :], zc, p.mean[i]).alias(f) for i, f in enumerate(p.features)])


@dataclass
class Mixture:
    weights: np.ndarray         # c
    means: np.ndarray           # c x k
    chol: np.ndarray            # c x k x k (lower Cholesky of each covariance)


#: Bytes of latent rows in a part of the EM's input, and rows that a task takes at a time.
EM_PART, EM_ROWS = 1 << 26, 2048
EPS = float(np.finfo(float).eps)


def em_blocks(latent: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows as binary blocks (n x d doubles, an Arrow batch each), dealt evenly and
    written once: a step costs the same for every task and converts no row."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float)
            parts = [np.ascontiguousarray(x[i:i + EM_ROWS]).tobytes() for i in range(0, len(x), EM_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["x"])

    blocks = materialize(latent.select(*cols).mapInArrow(pack, "x binary"), "em_blocks")
    size = blocks.agg(F.coalesce(F.sum(F.octet_length("x")), F.lit(0))).first()[0]
    return blocks.repartition(max(latent.sparkSession.sparkContext.defaultParallelism, -(-size // EM_PART)))


def _gaussian(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """A with |A (x - mean)|^2 the squared Mahalanobis distance, and the log of the density at the
    mean; directions without variance are left out (pseudo-inverse, as Spark ML)."""
    d, u = np.linalg.eigh(cov)
    some = d > EPS * d.max() * len(d)
    if not some.any():
        raise ValueError("a component's covariance is zero")
    root = np.where(some, 1 / np.sqrt(np.where(some, d, 1.0)), 0.0)[:, None] * u.T
    return root, -0.5 * (len(d) * math.log(2 * math.pi) + float(np.log(d[some]).sum()))


def _em_sums(x: np.ndarray, weights: np.ndarray, roots: np.ndarray, shift: np.ndarray, const: np.ndarray) -> np.ndarray:
    """The sums of an EM step over rows, flat: log-likelihood, then over components r, r x and r x x^T."""
    n, d = x.shape
    c = len(weights)
    y = x @ roots - shift
    p = EPS + weights * np.exp(const - 0.5 * np.square(y, out=y).reshape(n, c, d).sum(2))
    total = p.sum(1)
    r = p / total[:, None]
    rx = (r[:, :, None] * x[:, None, :]).reshape(n, c * d)
    return np.concatenate([[np.log(total).sum()], r.sum(0), rx.sum(0), (rx.T @ x).ravel()])


def fit_mixture(latent: DataFrame, k: int, n_components: int = 5, seed: int = 42, max_iter: int = 100, tol: float = 0.01) -> Mixture:
    """Gaussian mixture with full covariances on the latent rows.

    Start, steps and stop are those of Spark ML's GaussianMixture (the log-likelihood
    changes by at most ``tol``, or ``max_iter`` steps). Spark ML draws the start; a step
    is one pass over blocks of rows, each task returning its sums (5 x 111 numbers with
    the defaults)."""
    from pyspark import StorageLevel
    from pyspark.ml.clustering import GaussianMixture
    from tripwire.operators.models import fit_input
    cols = [f"z{j}" for j in range(k)]
    model = GaussianMixture(k=n_components, seed=seed, featuresCol="_features", maxIter=0).fit(fit_input(latent, cols))
    g = model.gaussiansDF.collect()         # n_components rows (bounded)
    weights = np.asarray(model.weights, dtype=float)
    means = np.array([np.asarray(r["mean"], dtype=float) for r in g])
    covs = np.array([np.asarray(r["cov"].toArray(), dtype=float) for r in g])
    c = n_components
    blocks = em_blocks(latent, cols).rdd.map(lambda row: bytes(row.x)).persist(StorageLevel.MEMORY_AND_DISK)
    last, now, steps = 0.0, -math.inf, 0
    while steps < max_iter and abs(now - last) > tol:
        made = [_gaussian(cov) for cov in covs]
        roots = np.concatenate([a.T for a, _ in made], axis=1)
        shift = np.concatenate([a @ m for (a, _), m in zip(made, means)])
        const = np.array([v for _, v in made])

        def step(raws: Iterator[bytes], weights=weights, roots=roots, shift=shift, const=const):
            sums = [_em_sums(np.frombuffer(raw).reshape(-1, k), weights, roots, shift, const) for raw in raws]
            return [np.sum(sums, axis=0)] if sums else []

        sums = np.sum(blocks.mapPartitions(step).collect(), axis=0)     # a row of sums per task
        n, first, second = sums[1:1 + c], sums[1 + c:1 + c + c * k].reshape(c, k), sums[1 + c + c * k:].reshape(c, k, k)
        weights, means = n / n.sum(), first / n[:, None]
        covs = second / n[:, None, None] - means[:, :, None] * means[:, None, :]
        last, now, steps = now, sums[0], steps + 1
    blocks.unpersist()
    chol = np.array([np.linalg.cholesky(cov + 1e-9 * np.eye(k)) for cov in covs])
    return Mixture(weights, means, chol)


def draw_mixture(spark: SparkSession, mix: Mixture, n: int, seed: str, id_offset: int = 0) -> DataFrame:
    """N latent rows from the mixture (id-seeded, partition independent)."""
    k = mix.means.shape[1]
    ids = spark.range(id_offset, id_offset + n).withColumnRenamed("id", ID)
    u = uniform01(F.col(ID), seed, slot=0)
    cum = np.cumsum(mix.weights)
    comp = F.lit(len(cum) - 1)
    for c in reversed(range(len(cum) - 1)):
        comp = F.when(u < F.lit(float(cum[c])), F.lit(c)).otherwise(comp)
    d = ids.withColumn("_c", comp).withColumns(
        {f"_e{j}": standard_normal(F.col(ID), seed, slot=1 + j) for j in range(k)})
    eps = [F.col(f"_e{j}") for j in range(k)]
    cols = {}
    for i in range(k):
        expr = None
        for c in range(len(mix.weights)):
            e = _lin(mix.chol[c, i, :], eps, mix.means[c, i])
            expr = e if expr is None else F.when(F.col("_c") == c, e).otherwise(expr)
        cols[f"z{i}"] = expr
    return d.select(ID, "_c", *[cols[f"z{i}"].alias(f"z{i}") for i in range(k)])


def mixture_decoys(real: DataFrame, n: int, features: Sequence[str] = FEATURES, key: str = "tx_id",
                   n_components: int = 10, mixture_k: int = 5, seed: int = 42,
                   anchors: int = 500, max_iter: int = 100, recheck: bool = False, max_rounds: int = 20) -> DataFrame:
    """PCA -> mixture -> draw n -> inverse -> drop the 10 % closest to
    <= 500 sampled real rows (strictly above the 10th percentile is kept) ->
    top up with fresh draws -> exactly n rows.

    The fresh draws skip the check, or with ``recheck`` must be farther from the
    same real rows than the first draws' percentile too: rounds of seeded draws, as
    many as the share that passed so far calls for, until n rows have passed; an
    error after ``max_rounds``."""
    spark = real.sparkSession
    p = fit_pca(real, features, n_components)
    mix = fit_mixture(project(real, p), p.k, mixture_k, seed, max_iter)
    draws = materialize(inverse(draw_mixture(spark, mix, n, f"gmm{seed}"), p), "draws")
    anc = first_n(real, key, f"{seed}:anchors", anchors)
    dist = materialize(nearest.min_dist_broadcast(draws, anc, ID, features), "draw_dist")
    thr = exact_percentile(dist, "min_dist", 0.10)
    kept = draws.join(dist.filter(F.col("min_dist") > F.lit(thr)).select(ID), ID)
    n_kept = kept.count()
    out, have, next_id, drawn = kept, n_kept, n, n
    for turn in range(max_rounds if recheck else 1):
        if have >= n:
            break
        more = n - have if not recheck else math.ceil((n - have) * drawn / max(have, 1)) + 16
        extra = inverse(draw_mixture(spark, mix, more, f"gmm{seed}:topup{turn if recheck else ''}", id_offset=next_id), p)
        if recheck:
            extra = materialize(extra, "topup")
            far = nearest.min_dist_broadcast(extra, anc, ID, features).filter(F.col("min_dist") > F.lit(thr)).select(ID)
            extra = materialize(first_n(extra.join(far, ID), ID, f"{seed}:topup{turn}", n - have), "topup-kept")
            have += extra.count()
        else:
            have = n
        out, next_id, drawn = out.unionByName(extra), next_id + more, drawn + more
    if have < n:
        raise RuntimeError(f"{have} of {n} draws passed the uniqueness cut in {max_rounds} rounds")
    return out.withColumn("source", F.lit("mixture"))


def snap_discrete(df: DataFrame, types: Sequence[str] = tuple(TYPE_COLUMNS), flags: Sequence[str] = tuple(FLAG_COLUMNS),
                  params: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Generated rows with their discrete features moved to the nearest valid
    value: exactly one of the ``types`` dummies is 1 (at equal distances the first),
    each of ``flags`` is 0 or 1 (half goes to 0). With ``params`` (feature -> mean,
    standard deviation) the features are z-scores, and so are the results. NULL or
    NaN dummies count as 0. One projection of column expressions, no shuffle."""
    def valid(c: str) -> tuple[float, float]:
        mean, std = (params or {}).get(c, (0.0, 1.0))
        return (0.0 - mean) / std, (1.0 - mean) / std

    def value(c: str):
        return F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.lit(valid(c)[0])).otherwise(F.col(c).cast("double"))

    out = {}
    if types:
        # against the row without any type, choosing c changes the squared distance by (x - one)^2 - (x - zero)^2
        gain = [F.struct(((value(c) - valid(c)[1]) * (value(c) - valid(c)[1]) - (value(c) - valid(c)[0]) * (value(c) - valid(c)[0])).alias("d"), F.lit(i).alias("i"))
                for i, c in enumerate(types)]
        best = F.array_min(F.array(*gain))["i"]
        out |= {c: F.when(best == i, F.lit(valid(c)[1])).otherwise(F.lit(valid(c)[0])) for i, c in enumerate(types)}
    out |= {c: F.when(F.abs(value(c) - valid(c)[1]) < F.abs(value(c) - valid(c)[0]), F.lit(valid(c)[1])).otherwise(F.lit(valid(c)[0])) for c in flags}
    return df.withColumns(out)


def uniqueness_cut(dist: DataFrame, col: str = "min_dist", q: float = 0.10) -> DataFrame:
    """Keep rows strictly farther than the q-quantile of the distances."""
    thr = exact_percentile(dist, col, q)
    return dist.filter(F.col(col) > F.lit(thr))


def latent_stats(latent: DataFrame, k: int) -> DataFrame:
    """Mean and population std per latent dimension (long form)."""
    aggs = []
    for j in range(k):
        aggs += [F.avg(f"z{j}").alias(f"m{j}"), F.stddev_pop(f"z{j}").alias(f"s{j}")]
    wide = latent.agg(*aggs)
    stack = ", ".join(f"{j}, m{j}, s{j}" for j in range(k))
    return wide.selectExpr(f"stack({k}, {stack}) AS (dim, mean, std)")


def latent_decoys(real: DataFrame, n: int, features: Sequence[str] = FEATURES, latent_dim: int = 8,
                  noise_std: float = 0.5, seed: int = 42) -> DataFrame:
    """Encode with a linear (PCA) encoder, draw z ~ N(mean, std * noise)
    per dimension, decode, clip into real mean +- 3 std (P19)."""
    spark = real.sparkSession
    p = fit_pca(real, features, latent_dim)
    st = {r["dim"]: (r["mean"], r["std"]) for r in latent_stats(project(real, p), p.k).collect()}
    ids = spark.range(n).withColumnRenamed("id", ID)
    z = ids.select(ID, *[(F.lit(st[j][0]) + F.lit(st[j][1] * noise_std) *
                          standard_normal(F.col(ID), f"lat{seed}", slot=j)).alias(f"z{j}") for j in range(p.k)])
    return prep.clip_to_real(inverse(z, p), real, features).withColumn("source", F.lit("latent"))


def discriminator(real: DataFrame, decoys: DataFrame, features: Sequence[str] = FEATURES,
                  real_key: str = "tx_id", decoy_key: str = ID, num_trees: int = 100,
                  max_depth: int = 10, seed: int = 42) -> dict:
    """Q1-Q3: balanced real/decoy union, 80/20 split, random forest telling
    them apart; accuracy and support-weighted precision / recall / F1."""
    from tripwire.operators import metrics, models
    feats = list(features)
    n = min(real.count(), decoys.count())
    r = first_n(real.select(F.col(real_key).cast("string").alias("_k"), *feats), "_k", seed, n)
    d = first_n(decoys.select(F.col(decoy_key).cast("string").alias("_k"), *feats), "_k", seed, n)
    both = (r.withColumn("source", F.lit(0)).unionByName(d.withColumn("source", F.lit(1)))
            .withColumn("_k", F.concat_ws(":", F.col("source").cast("string"), "_k")))
    split = materialize(prep.holdout_split(both, 0.2, key="_k", seed=seed))
    model = models.fit_random_forest(split.filter(F.col("split") == "train"), feats, "source",
                                     num_trees, max_depth, seed)
    pred = models.positive_proba(model, split.filter(F.col("split") == "test"), feats)
    m = metrics.weighted_metrics(pred.withColumn("label", F.col("source")), "pred", "label").first()
    return {"discriminator_accuracy": m["accuracy"], "discriminator_f1": m["f1"],
            "discriminator_precision": m["precision"], "discriminator_recall": m["recall"]}


def evaluate_quality(real: DataFrame, decoys: DataFrame, features: Sequence[str] = FEATURES,
                     real_key: str = "tx_id", decoy_key: str = ID, **rf) -> tuple[dict, DataFrame]:
    """Q9: discriminator metrics + per-feature report summary; pass = acc <= 0.65."""
    from tripwire.operators import quality
    long = quality.stack(real, decoys, features)
    report = materialize(quality.quality_report(long, digits=None), "report")
    agg = report.agg(F.sum(F.col("mean_ok").cast("int")).alias("ok"), F.avg("kl_div").alias("kl"),
                     F.avg("ks_pval").alias("ks")).first()
    out = discriminator(real, decoys, features, real_key, decoy_key, **rf)
    out.update({"features_within_2sd": int(agg["ok"] or 0), "mean_kl_divergence": agg["kl"],
                "mean_ks_pvalue": agg["ks"], "quality_pass": out["discriminator_accuracy"] <= DISCRIMINATOR_PASS})
    rounded = ["real_mean", "decoy_mean", "real_std", "decoy_std", "ks_pval", "kl_div"]
    return out, report.withColumns({c: F.bround(F.col(c), 4) for c in rounded})


def generate_decoys(real: DataFrame, n: int, features: Sequence[str] = FEATURES, key: str = "tx_id",
                    force_mixture: bool = False, seed: int = 42, **rf) -> tuple[DataFrame, dict]:
    """Latent generator first; if its discriminator accuracy is above
    0.65 switch to the PCA + mixture generator (evaluated once)."""
    if not force_mixture:
        dec = materialize(latent_decoys(real, n, features, seed=seed), "decoys")
        q, _ = evaluate_quality(real, dec, features, key, **rf)
        if q["quality_pass"]:
            q["method"] = "latent"
            return dec, q
    dec = materialize(mixture_decoys(real, n, features, key, seed=seed), "decoys")
    q, _ = evaluate_quality(real, dec, features, key, **rf)
    q["method"] = "mixture"
    return dec, q
