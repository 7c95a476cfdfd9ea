"""Ledger preparation: drop, derive, encode, sample, split, scale.

All column work is native expressions in one projection; splits and samples
use the bucketed rank cuts of ``ranking`` (exact sizes, no Bernoulli sampling,
no single-task window); scaler parameters are one aggregate row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.functions.draws import draw_key
from tripwire.operators.ranking import first_n, scalar, segment_by_rank
from tripwire.schema import (DROP_COLS, FEATURES, KEY, LABEL, RATIO_EPS, RISKY_TYPES, SEED,
                             TEST_SIZE, TYPE_DOMAIN, VAL_SIZE)


def drop_ids(df: DataFrame) -> DataFrame:
    """Drop identifier and leakage columns."""
    return df.drop(*DROP_COLS)


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def engineer_features(df: DataFrame, normalize_first: bool = False) -> DataFrame:
    """P2-P6. ``is_risky_type`` is evaluated on the raw type text (as in the
    reference, where a raw ``CASH-OUT`` is not risky) unless ``normalize_first``."""
    t = F.regexp_replace("type", "-", "_") if normalize_first else F.col("type")
    return df.withColumns({
        "orig_balance_diff": (F.col("newbalanceOrig") - F.col("oldbalanceOrg") + F.col("amount")).cast("double"),
        "dest_balance_diff": (F.col("newbalanceDest") - F.col("oldbalanceDest") - F.col("amount")).cast("double"),
        "amount_to_orig_ratio": _d("amount") / (_d("oldbalanceOrg") + F.lit(RATIO_EPS)),
        "amount_to_dest_ratio": _d("amount") / (_d("oldbalanceDest") + F.lit(RATIO_EPS)),
        "orig_zeroed": (F.col("newbalanceOrig") == 0).cast("int"),
        "is_risky_type": t.isin(*RISKY_TYPES).cast("int"),
    })


def normalize_type(df: DataFrame) -> DataFrame:
    """P7: '-' -> '_' in the type text."""
    return df.withColumn("type", F.regexp_replace("type", "-", "_"))


def one_hot_type(df: DataFrame, extra_types: str = "ignore") -> DataFrame:
    """One dummy per type of the fixed domain (all five always present).

    ``extra_types='error'`` fails the job on a type outside the domain;
    ``'ignore'`` encodes it as all zeros, like a NULL type.
    """
    t = F.col("type")
    out = df
    if extra_types == "error":
        out = out.withColumn("type", F.when(t.isin(*TYPE_DOMAIN), t).otherwise(
            F.raise_error(F.concat(F.lit("unknown transaction type: "), t))))
    return out.withColumns({f"type_{v}": F.coalesce((F.col("type") == v).cast("int"), F.lit(0)) for v in TYPE_DOMAIN}).drop("type")


def feature_frame(raw: DataFrame, normalize_first: bool = False) -> DataFrame:
    """P1-P10 in one projection: key, the 17 features as DOUBLE (canonical
    order), label."""
    df = one_hot_type(normalize_type(engineer_features(drop_ids(raw), normalize_first)))
    return df.select(KEY, *[F.col(f).cast("double").alias(f) for f in FEATURES], F.col(LABEL).cast("int"))


def sample_exact(df: DataFrame, frac: float, key: str = KEY, seed=SEED,
                 rounding: str = "round") -> DataFrame:
    """P11 (round) / P17 (floor): exactly round(frac*n) (or floor) rows, seeded."""
    f = F.lit(float(frac))
    if rounding == "round":
        return first_n(df, key, seed, lambda tot: F.floor(tot * f + F.lit(0.5)))
    return first_n(df, key, seed, lambda tot: F.floor(tot * f))


def legit_only(df: DataFrame, label: str = LABEL) -> DataFrame:
    """P12."""
    return df.filter(F.col(label) == 0)


def pool_size(n_train: Column, n_decoys: int | None = None) -> Column:
    """n_decoys, or max(500, int(0.10 * n_train)) when unset/0."""
    if n_decoys:
        return F.lit(int(n_decoys)).cast("bigint")
    return F.greatest(F.lit(500).cast("bigint"), F.floor(n_train * F.lit(0.10)).cast("bigint"))


def quantile_threshold(df: DataFrame, col: str, q: float) -> Column:
    """Exact linear-interpolated percentile as a lazy scalar (numpy's default)."""
    from tripwire.operators.cumulative import exact_percentile
    return F.lit(exact_percentile(df, col, q))


def high_value_rows(df: DataFrame, col: str = "amount", top_pct: float = 20.0) -> DataFrame:
    """Rows with col >= percentile(col, 100 - top_pct); ties kept."""
    thr = quantile_threshold(df, col, (100.0 - top_pct) / 100.0)
    return df.filter(F.col(col) >= thr)


def stratified_split(df: DataFrame, label: str = LABEL, key: str = KEY, seed=SEED,
                     test_size: float = TEST_SIZE, val_size: float = VAL_SIZE) -> DataFrame:
    """Per-label exact allocation into test / val / train.

    Inside each label the rows are ordered by md5(key:seed); the first
    round(test*n_c) are test, the next round(val/(1-test) * rest) are val
    (so val is ``val_size`` of the whole), the rest train.
    """
    from fractions import Fraction
    t = F.lit(float(test_size))
    # val share of the remainder, as the exact ratio val / (1 - test) (1/8 by default)
    v = F.lit(float(Fraction(str(val_size)) / (1 - Fraction(str(test_size)))))

    def cuts(tot: Column):
        n_test = F.floor(tot * t + F.lit(0.5))
        n_val = F.floor((tot - n_test) * v + F.lit(0.5))
        return [n_test, n_test + n_val]

    seg = segment_by_rank(df, draw_key(key, seed), [key], cuts, parts=[label], out="_seg")
    name = F.when(F.col("_seg") == 0, "test").when(F.col("_seg") == 1, "val").otherwise("train")
    return seg.withColumn("split", name).drop("_seg")


def unscaled_train(split_frame: DataFrame) -> DataFrame:
    """The training rows of a split feature frame (key, features, label)
    before the z-score, for interpretable output."""
    return split_frame.filter(F.col("split") == "train").drop("split")


def holdout_split(df: DataFrame, test_size: float = 0.2, key: str = KEY, seed=SEED) -> DataFrame:
    """Unstratified split; the first round(test*n) rows by md5 order are test."""
    t = F.lit(float(test_size))
    seg = segment_by_rank(df, draw_key(key, seed), [key],
                          lambda tot: [F.floor(tot * t + F.lit(0.5))], out="_seg")
    return seg.withColumn("split", F.when(F.col("_seg") == 0, "test").otherwise("train")).drop("_seg")


def split_stats(split_df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows and positive rate per split."""
    return split_df.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.sum(F.col(label)).cast("bigint").alias("n_pos"),
        F.avg(F.col(label).cast("double")).alias("pos_rate"))


def class_distribution(df: DataFrame, label: str = LABEL, by: Sequence[str] = ()) -> DataFrame:
    """N, legit, fraud, fraud percentage (one conditional aggregation)."""
    y = F.col(label)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum(F.when(y == 0, 1).otherwise(0)).cast("bigint").alias("n_legit"),
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("n_fraud"),
        (F.sum(F.when(y == 1, 1.0).otherwise(0.0)) * 100.0 / F.count(F.lit(1))).alias("fraud_pct"))


# ---- scaling (N2) -----------------------------------------------------------

def fit_scaler(train: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """N2 fit: mean and population std per feature, one pass, as a long
    parameter table ``(feature, mean, std)`` (the persisted scaler, S8)."""
    aggs = []
    for f in features:
        aggs += [F.avg(F.col(f)).alias(f"m__{f}"), F.stddev_pop(F.col(f)).alias(f"s__{f}")]
    wide = train.agg(*aggs)
    stack = ", ".join(f"'{f}', `m__{f}`, `s__{f}`" for f in features)
    return wide.selectExpr(f"stack({len(features)}, {stack}) AS (feature, mean, std)")


def scaler_params(params: DataFrame) -> dict[str, tuple[float, float]]:
    """The (feature -> (mean, std)) map; d rows, bounded by the feature count."""
    return {r["feature"]: (r["mean"], r["std"]) for r in params.collect()}


def apply_scaler(df: DataFrame, params: DataFrame | dict, features: Sequence[str] = FEATURES) -> DataFrame:
    """N2 apply: (x - mean) / std, a zero std replaced by 1 (as sklearn)."""
    p = scaler_params(params) if isinstance(params, DataFrame) else params
    cols = {}
    for f in features:
        m, s = p[f]
        s = 1.0 if (s is None or s == 0.0) else s
        cols[f] = (F.col(f) - F.lit(m)) / F.lit(s)
    return df.withColumns(cols)


def clip_to_real(df: DataFrame, real: DataFrame, features: Sequence[str] = FEATURES,
                 k: float = 3.0) -> DataFrame:
    """Clip each feature into real mean +- k * population std."""
    p = scaler_params(fit_scaler(real, features))
    cols = {}
    for f in features:
        m, s = p[f]
        s = s or 0.0
        cols[f] = F.least(F.greatest(F.col(f), F.lit(m - k * s)), F.lit(m + k * s))
    return df.withColumns(cols)
