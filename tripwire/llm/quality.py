"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every rule rejects texts whose statistic is over a cutoff. The cutoffs are not
chosen by hand: a fixed sequence of joint settings, from lenient to strict,
names one cutoff for each rule. For each stratum (language), the labelled good
documents are a holdout on which each setting is tested with the exact binomial
tail

    P(Bin(n, alpha) <= k)  <=  delta / strata

(n good documents, k of them rejected by any rule of the setting), which holds
exactly when the Clopper-Pearson upper bound of the false rejection rate is at
most alpha. The settings are tested in order up to the first failure
(fixed-sequence testing, so they share one level); strata are corrected by
Bonferroni. So, with probability 1 - delta, every certified setting of every
stratum rejects at most a share alpha of its good documents. Of the certified
settings the one that rejects most labelled bad documents, less the good ones,
is taken, the most lenient in a tie. A stratum without enough labels (under
log(delta / strata) / log(1 - alpha) good ones, 86 for four strata) gets no
setting: nothing is rejected there beyond the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripwire.llm.common import SPACE_RE, write_once

P = "__q_"
#: Share of a stratum's good documents that all rules together may reject, and
#: the probability with which any of the strata's bounds may fail.
ALPHA, DELTA = 0.05, 0.05
#: Rules: (name, statistic over the feature columns, cutoffs from lenient to strict).
RULES: list[tuple[str, str, list[float]]] = [
    ("symbols_per_word", "n_symbols / n_words", [2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1]),
    ("upper_share", "n_upper / word_chars", [0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2]),
    ("repeat_share", "n_repeat_words / n_words", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3]),
    ("dup_line_share", "n_dup_lines / n_lines", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35]),
    ("word_length", "word_chars / n_words", [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 13.0, 12.0]),
]
#: Joint settings, from lenient to strict: each rule walks its cutoffs in even steps over all of them.
N_SETTINGS = max(len(grid) for _, _, grid in RULES)
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def add_features(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with the feature columns, prefixed ``__q_``; a null text counts as empty.

    n_repeat_words finds windows that occur twice through their sorted 64-bit
    hashes; only texts with an equal pair of hashes are sorted.
    """
    q = lambda name: F.col(P + name)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = df.withColumn(P + "text", text) \
        .withColumn(P + "words", F.array_remove(F.split(q("text"), SPACE_RE), "")) \
        .withColumn(P + "lines", F.filter(F.split(q("text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))) \
        .withColumn(P + "n_words", F.size(q("words")).cast("long"))
    at = lambda i: F.get(q("words"), i)
    d = d.withColumn(P + "h", F.when(q("n_words") < 3, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(0), (q("n_words") - 3).cast("int")), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))))
    d = d.withColumn(P + "s", F.when(F.size(F.array_distinct(q("h"))) == F.size(q("h")), F.array().cast("array<struct<h:bigint,i:int>>"))
                     .otherwise(F.sort_array(F.transform(q("h"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter(q("s"), lambda x, j: (F.get(q("s"), j - 1)["h"] == x["h"]) | F.coalesce(F.get(q("s"), j + 1)["h"] == x["h"], F.lit(False)))
    covered = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return d.withColumn(P + "word_chars", F.char_length(F.array_join(q("words"), "")).cast("long")) \
        .withColumn(P + "n_symbols", F.char_length(F.regexp_replace(q("text"), r"[^#*$%&|<>]+", "")).cast("long")) \
        .withColumn(P + "n_upper", F.char_length(F.regexp_replace(q("text"), r"[^\p{Lu}]+", "")).cast("long")) \
        .withColumn(P + "n_lines", F.size(q("lines")).cast("long")) \
        .withColumn(P + "n_dup_lines", (F.size(q("lines")) - F.size(F.array_distinct(q("lines")))).cast("long")) \
        .withColumn(P + "n_repeat_words", F.size(F.array_distinct(covered)).cast("long")) \
        .withColumn(P + "base_failed", (q("n_words") < 50) | (100 * q("n_repeat_words") > 50 * q("n_words"))) \
        .drop(P + "text", P + "words", P + "lines", P + "h", P + "s")


def statistic(expr: str) -> Column:
    """A rule's statistic over the prefixed columns; zero where undefined."""
    top, bottom = (P + x.strip() for x in expr.split("/"))
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed exactly from the k-th term down: the state keeps
    that term's logarithm and the sum of the terms relative to it."""
    import math
    odds = p / (1 - p)
    start = F.struct((n * F.lit(math.log1p(-p))).alias("lt"), F.lit(1.0).alias("s"))
    step = lambda i: F.lit(odds) * (n - i + 1) / i
    return F.when(k <= 0, F.exp(n * F.lit(math.log1p(-p)))).otherwise(F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long"))), start,
        lambda a, i: F.struct((a["lt"] + F.log(step(i))).alias("lt"), (a["s"] / step(i) + 1).alias("s")),
        lambda a: F.exp(a["lt"] + F.log(a["s"]))))


def cutoff_at(grid: list[float], setting: int, settings: int) -> float:
    """A rule's cutoff in a joint setting, 1 the most lenient."""
    return grid[-(-setting * len(grid) // settings) - 1]


def first_setting(rules=None) -> Column:
    """The most lenient joint setting that rejects the row, one over the number of settings if none does."""
    rules = rules or RULES
    m = max(len(grid) for _, _, grid in rules)
    return F.array_min(F.array(*[sum((F.when(statistic(e) > cutoff_at(grid, j, m), 0).otherwise(1) for j in range(1, m + 1)), F.lit(1))
                                 for _, e, grid in rules]))


def thresholds(feats: DataFrame, id_col: str, stratum_col: str, labels: DataFrame, label_id: str = "doc_id",
               label_col: str = "quality", alpha: float = ALPHA, delta: float = DELTA, rules=None) -> DataFrame:
    """One row per stratum with labels: (stratum, setting or null, n_good, n_bad,
    n_false, n_caught, tail). A document labelled more than once counts once, as good if
    any label says so; null labels and ids are ignored."""
    rules = rules or RULES
    m = max(len(grid) for _, _, grid in rules)
    marks = labels.select(F.col(label_id).alias("__id"), F.col(label_col).cast("int").alias("good")) \
        .filter("__id IS NOT NULL AND good IS NOT NULL").groupBy("__id").agg((F.max("good") > 0).alias("good"))
    held = feats.withColumn("__id", F.col(id_col)).join(marks, "__id") \
        .select(stratum(stratum_col).alias("stratum"), "good", first_setting(rules).alias("first")) \
        .groupBy("stratum", "first").agg(F.sum(F.when(F.col("good"), 1).otherwise(0)).alias("g"),
                                         F.sum(F.when(F.col("good"), 0).otherwise(1)).alias("b"))
    # from here on tables of strata x settings
    sums = held.groupBy("stratum").agg(F.sum("g").alias("n_good"), F.sum("b").alias("n_bad"),
                                       F.collect_list(F.struct("first", "g", "b")).alias("hist"))
    upto = lambda f: F.aggregate(F.col("hist"), F.lit(0).cast("long"),
                                 lambda a, x: a + F.when(x["first"] <= F.col("j"), x[f]).otherwise(0))
    cand = sums.crossJoin(sums.agg(F.count("*").alias("n_strata"))) \
        .withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(m)))).withColumn("n_false", upto("g")).withColumn("n_caught", upto("b"))  # joined with one row
    # over the expected count the tail is no small probability: not summed, not certified
    cand = cand.withColumn("tail", F.when(F.col("n_false") <= F.col("n_good") * alpha,
                                          binomial_tail(F.col("n_good"), F.col("n_false"), alpha)).otherwise(F.lit(1.0))) \
        .withColumn("ok", F.col("tail") <= F.lit(delta) / F.col("n_strata"))
    order = W.partitionBy("stratum").orderBy("j").rowsBetween(W.unboundedPreceding, 0)
    cand = cand.withColumn("ok", F.min(F.col("ok").cast("int")).over(order) == 1)
    gain = F.col("n_caught") - F.col("n_false")
    best = F.max_by(F.struct("j", "n_false", "n_caught", "tail"), F.when(F.col("ok") & (gain > 0), F.struct(gain.alias("g"), (-F.col("j")).alias("j"))))
    return cand.groupBy("stratum").agg(F.first("n_good").alias("n_good"), F.first("n_bad").alias("n_bad"), best.alias("x")) \
        .select("stratum", F.col("x.j").alias("setting"), "n_good", "n_bad", "x.n_false", "x.n_caught", "x.tail")


def stratum(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def judge(feats: DataFrame, labels: DataFrame, id_col: str, stratum_col: str, alpha: float = ALPHA,
          delta: float = DELTA) -> DataFrame:
    """``feats`` (rows with feature columns) with failed_rules (names) and kept.

    The rows are written once; the settings come from the labelled ones and are
    joined by stratum, a table of one row per stratum."""
    feats, _ = write_once(feats, "quality")
    cuts = thresholds(feats, id_col, stratum_col, labels, alpha=alpha, delta=delta).filter("setting IS NOT NULL") \
        .select(F.col("stratum").alias(P + "stratum"), F.col("setting").alias(P + "setting"))
    cuts, _ = write_once(cuts, "quality-cuts")
    out = feats.withColumn(P + "stratum", stratum(stratum_col)).join(cuts, P + "stratum", "left")
    cutoff = lambda grid: F.get(F.array(*[F.lit(cutoff_at(grid, j, N_SETTINGS)) for j in range(1, N_SETTINGS + 1)]), F.col(P + "setting") - 1)
    fails = [F.when(statistic(e) > cutoff(grid), F.lit(name)) for name, e, grid in RULES]
    return out.withColumn(P + "failed_rules", F.array_compact(F.array(*fails))) \
        .withColumn(P + "kept", ~F.col(P + "base_failed") & (F.size(P + "failed_rules") == 0)) \
        .drop(P + "setting", P + "stratum")


def quality_rules(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per input row: id, the base features, base_failed, kept and failed_rules.

    Rows are judged one by one, repeated rows and null ids too. A null text has
    no words and fails the base rule; a null stratum is a stratum of its own.
    Only features are written, never the texts; other columns are not read. An
    empty table gives an empty result, no labels mean base rules only.
    """
    slim = df.select(F.col(id_col).alias("__id0"), F.col(text_col).alias("__text"), F.col(stratum_col).alias("__lang"))
    out = judge(add_features(slim, "__text").drop("__text"), labels, "__id0", "__lang", alpha, delta)
    return out.select(F.col("__id0").alias(id_col), *[F.col(P + n).alias(n) for n in [*BASE, "base_failed", "kept", "failed_rules"]])


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``df`` that the rules keep, with its columns. The rows are
    written with their features, so no text is shuffled."""
    return judge(add_features(df, text_col), labels, id_col, stratum_col, alpha, delta) \
        .filter(F.col(P + "kept")).select(*df.columns)
