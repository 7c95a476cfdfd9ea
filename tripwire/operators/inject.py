"""Decoy injection: budget, zone quotas, placement strategies, assembly.

Strategies are ``(real, decoys, k, ctx) -> DataFrame`` of ``k`` decoy rows; the
registry maps zone names to strategies and unknown zones fall back to random
placement (I7). Every top-k is an exact rank cut (no global sort into one
task), every distance a J3 nearest-anchor computation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.functions.buckets import log_bucket
from tripwire.functions.draws import draw_key
from tripwire.operators import nearest
from tripwire.operators.ranking import first_n, global_rank, scalar, segment_by_rank
from tripwire.session import materialize
from tripwire.schema import DEFAULT_INJECTION_RATIO, DENSITY_RATIOS, FEATURES, ZONES

Strategy = Callable[[DataFrame, DataFrame, int, "InjectContext"], DataFrame]


@dataclass
class InjectContext:
    key: str = "tx_id"
    label: str = "isFraud"
    features: Sequence[str] = tuple(FEATURES)
    amount: str = "amount"
    seed: int = 42
    rf_trees: int = 50
    rf_depth: int = 10
    kmeans_k: int = 8
    boundary_frac: float = 0.15
    boundary_anchors: int = 200
    high_value_pct: float = 20.0
    extra: dict = field(default_factory=dict)


# ---- budgets (I1, I2, I11) ----------------------------------------------------

def decoy_budget(n_real: int, n_pool: int, ratio: float = DEFAULT_INJECTION_RATIO) -> int:
    """min(int(n * r / (1 - r)), pool size)."""
    return min(int(n_real * ratio / (1 - ratio)), n_pool)


def zone_quotas(budget: int, weights: dict[str, float] | None = None) -> dict[str, int]:
    """max(1, int(budget * weight)) per zone (weights not validated)."""
    weights = weights or {z: 0.25 for z in ZONES}
    return {z: max(1, int(budget * w)) for z, w in weights.items()}


def density_sweep(real: DataFrame, decoys: DataFrame, ratios: Sequence[float] = DENSITY_RATIOS) -> DataFrame:
    """For each injection ratio, decoys (capped by the pool), total, percentage."""
    spark = real.sparkSession
    n_real, n_pool = real.count(), decoys.count()
    r = spark.createDataFrame([(float(x),) for x in ratios], "injection_ratio double")
    n = F.least(F.floor(F.lit(n_real) * F.col("injection_ratio") / (1 - F.col("injection_ratio"))),
                F.lit(n_pool)).cast("bigint")
    return (r.withColumn("n_real", F.lit(n_real).cast("bigint")).withColumn("n_decoys", n)
            .withColumn("total", F.col("n_real") + F.col("n_decoys"))
            .withColumn("actual_pct", F.col("n_decoys") / F.col("total") * 100.0))


# ---- exact top-k by a numeric score ------------------------------------------

def smallest_k(df: DataFrame, order: Column, key: str, k, prefix_bucket: Column | None = None) -> DataFrame:
    """Rows with the k smallest ``order`` values (key breaks ties), by a rank cut
    on a monotone bucket of the value.

    The scored rows are written once (the score is usually a nearest-anchor
    distance or a model probability, too costly to compute twice), and ties on
    a hot value are split by the key (``segment_by_rank(split_ties=True)``)."""
    c = k if callable(k) else (lambda tot: F.lit(int(k)))
    d = materialize(df.withColumn("_ord", order), "smallest-k")
    b = prefix_bucket if prefix_bucket is not None else log_bucket(F.col("_ord"))
    seg = segment_by_rank(d, F.col("_ord"), [key], lambda tot: [c(tot)], out="_s", bucket=b,
                          split_ties=True)
    return seg.filter(F.col("_s") == 0).drop("_s", "_ord")


# ---- strategies (I3-I7) ----------------------------------------------------------

def strategy_random(real: DataFrame, decoys: DataFrame, k: int, ctx: InjectContext, seed=None) -> DataFrame:
    """K pool rows without replacement (seeded)."""
    return first_n(decoys, ctx.key, seed if seed is not None else f"{ctx.seed}:random", int(k))


def boundary_rows(scored: DataFrame, score: str, key: str, frac: float = 0.15) -> DataFrame:
    """The int(frac * n) rows with score closest to 0.5 (key breaks ties)."""
    f = F.lit(float(frac))
    return smallest_k(scored, F.abs(F.col(score) - F.lit(0.5)), key, lambda tot: F.floor(tot * f))


def _nearest_first(decoys: DataFrame, anchors: DataFrame, k: int, ctx: InjectContext, **kw) -> DataFrame:
    d = nearest.min_dist_cells(decoys, anchors, ctx.key, ctx.features, k=int(k), **kw)
    top = smallest_k(d, F.col("min_dist"), ctx.key, int(k))
    return decoys.join(top, ctx.key)


def strategy_edge_case(real: DataFrame, decoys: DataFrame, k: int, ctx: InjectContext) -> DataFrame:
    """I4: RF on the real rows; rows with P(fraud) nearest 0.5; <= 200 of them
    sampled; decoys nearest to those anchors. One label only -> random."""
    if real.select(ctx.label).distinct().count() < 2:
        return strategy_random(real, decoys, k, ctx)
    from tripwire.operators.models import fit_random_forest, positive_proba
    model = fit_random_forest(real, ctx.features, ctx.label, ctx.rf_trees, ctx.rf_depth, ctx.seed)
    scored = positive_proba(model, real, ctx.features, out="_p")
    bnd = boundary_rows(scored, "_p", ctx.key, ctx.boundary_frac)
    anchors = first_n(bnd, ctx.key, f"{ctx.seed}:edge", ctx.boundary_anchors)
    return _nearest_first(decoys, anchors, k, ctx)


def strategy_cluster(real: DataFrame, decoys: DataFrame, k: int, ctx: InjectContext) -> DataFrame:
    """K-means (k = min(8, n // 10)) on real rows; decoys nearest to any
    centroid, first k overall."""
    from tripwire.operators.models import fit_kmeans
    n = real.count()
    kk = min(ctx.kmeans_k, n // 10)
    if kk < 1:
        raise ValueError(f"cluster placement needs >= 10 real rows, got {n}")
    centers = fit_kmeans(real, ctx.features, kk, ctx.seed)
    return _nearest_first(decoys, centers, k, ctx)


def high_value_anchors(real: DataFrame, amount: str, top_pct: float = 20.0) -> DataFrame:
    """P15 anchors: real rows with amount >= percentile(amount, 100 - top_pct)."""
    from tripwire.operators.prep import high_value_rows
    return high_value_rows(real, amount, top_pct)


def strategy_high_value(real: DataFrame, decoys: DataFrame, k: int, ctx: InjectContext, **kw) -> DataFrame:
    """Decoys nearest (full feature space) to the top-20 % amount rows;
    no anchors -> random."""
    anchors = high_value_anchors(real, ctx.amount, ctx.high_value_pct)
    if anchors.limit(1).count() == 0:
        return strategy_random(real, decoys, k, ctx)
    return _nearest_first(decoys, anchors, k, ctx, **kw)


STRATEGIES: dict[str, Strategy] = {
    "random": strategy_random,
    "edge_case": strategy_edge_case,
    "cluster": strategy_cluster,
    "high_value": strategy_high_value,
}


def place(zone: str, real: DataFrame, decoys: DataFrame, k: int, ctx: InjectContext) -> DataFrame:
    """Dispatch by zone name; unknown zones use random placement."""
    fn = STRATEGIES.get(zone)
    if fn is None:
        out = strategy_random(real, decoys, k, ctx, seed=f"{ctx.seed}:{zone}")
    else:
        out = fn(real, decoys, k, ctx)
    return out.select(*decoys.columns)


# ---- assembly (I8-I10, I12) ---------------------------------------------------------

def assemble(real: DataFrame, placed: DataFrame, ctx: InjectContext, columns: Sequence[str]) -> DataFrame:
    """I8: real rows (is_decoy false, zone NULL) ∪ placed decoys (label 0,
    is_decoy true, zone). A decoy placed by several zones appears once per zone."""
    cols = list(columns)
    r = real.select(*cols, F.col(ctx.label).cast("int").alias(ctx.label),
                    F.lit(False).alias("is_decoy"), F.lit(None).cast("string").alias("zone"))
    d = placed.select(*cols, F.lit(0).alias(ctx.label), F.lit(True).alias("is_decoy"), "zone")
    return r.unionByName(d)


def shuffle_rank(df: DataFrame, key: str, seed, out: str = "pos") -> DataFrame:
    """A seeded random permutation as a dense 0-based position."""
    k = F.concat_ws("|", F.col(key).cast("string"), F.coalesce(F.col("zone"), F.lit("")))
    ranked = global_rank(df.withColumn("_sk", k), draw_key(F.col("_sk"), seed), ["_sk"], out=out)
    return ranked.withColumn(out, F.col(out) - 1).drop("_sk")


def inject_report(injected: DataFrame) -> DataFrame:
    """Real, decoys, total and actual decoy percentage."""
    dec = F.sum(F.col("is_decoy").cast("int"))
    return injected.agg(
        F.sum((~F.col("is_decoy")).cast("int")).cast("bigint").alias("n_real"),
        dec.cast("bigint").alias("n_decoys"), F.count(F.lit(1)).cast("bigint").alias("total"),
    ).withColumn("actual_pct", F.col("n_decoys") / F.col("total") * 100.0)


def inject_decoys(real: DataFrame, decoys: DataFrame, ctx: InjectContext | None = None,
                  ratio: float = DEFAULT_INJECTION_RATIO, weights: dict[str, float] | None = None,
                  hash_col: str = "row_hash") -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Place decoys in every zone, assemble, permute, and register.

    ``decoys`` must carry ``hash_col`` (computed once from the decoy's content)
    so the lookup and the injected rows use the same value. Both inputs are
    written once: every zone reads them several times. Returns
    (injected with ``pos``, lookup ``(row_hash, zone)``, quotas).
    """
    from tripwire.operators.lookup import register
    ctx = ctx or InjectContext()
    real, decoys = materialize(real, "inject_real"), materialize(decoys, "inject_pool")
    budget = decoy_budget(real.count(), decoys.count(), ratio)
    quotas = zone_quotas(budget, weights)
    placed = None
    for zone, k in quotas.items():
        part = place(zone, real, decoys, k, ctx).withColumn("zone", F.lit(zone))
        placed = part if placed is None else placed.unionByName(part)
    placed = materialize(placed, "placed")
    cols = [ctx.key, *ctx.features, hash_col]
    injected = shuffle_rank(assemble(real, placed, ctx, cols), ctx.key, ctx.seed)
    return injected, register(placed.select(hash_col, "zone"), hash_col), quotas


def n_rows(df: DataFrame) -> int:
    return scalar(df.select(F.count(F.lit(1))))
