"""SimHash near-duplicates by pigeonring filtering.

Fingerprints: one 64-bit majority vote over the XXH64 values of all word
shingles. Search: the 64 bits form a ring of m = d + 1 segments for a distance
limit d. By the pigeonring principle, of two fingerprints within d bits some
segment starts a chain whose first l segments differ in at most l * d / m bits,
for every l: none in the first, at most one in the first two, at most d in all.
The index keys follow that budget: the first segment whole, one half of the
second (one bit of difference leaves a half unchanged) and one of d + 1 parts of
the third. Pairs that share a key are held against the chain budgets, and only
then against the full Hamming distance, inside the join condition, so no
candidate pair is ever a row.

The work is on distinct fingerprints: copies are one row before the search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm.common import Sides, components, drop_path, group_of, write_once, write_sides

SEED = 42
#: Shingles counted at once: bounds the bit matrix of a very long text to 64 x this.
BLOCK = 1 << 18


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a whole text: A-Z lower-cased, words between ASCII
    white space, ``shingle``-word shingles with repeats, fewer words: the whole
    sequence, none (or null): zero. A bit is 1 if set in over half the hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    first, last = starts[: len(words) - k + 1], ends[k - 1:]
    xxh = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(first), BLOCK):
        cuts = zip(first[at: at + BLOCK].tolist(), last[at: at + BLOCK].tolist())
        h = np.array([xxh(joined[s:e], SEED) for s, e in cuts], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (votes * 2 > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_column(text_col: str, shingle: int = 3) -> Column:
    """The fingerprint as a signed long, computed in Arrow batches of the scan."""
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        fps = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(fps.view(np.int64))

    return run(F.col(text_col).cast("string"))


def _ring(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of the m = distance + 1 segments of the 64-bit ring."""
    m = distance + 1
    cuts = [64 * i // m for i in range(m + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(m)]


def _mask(shift: int, width: int) -> int:
    return ((1 << width) - 1) << shift


def _parts(shift: int, width: int, n: int) -> list[int]:
    cuts = [width * i // n for i in range(n + 1)]
    return [_mask(shift + cuts[i], cuts[i + 1] - cuts[i]) for i in range(n)]


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >= 1 << 63 else x).cast("long")


def ring_keys(distance: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """The index keys: (mask of the bits that must agree, chain budgets
    [(mask of the first l segments, most differing bits), ...])."""
    if not 1 <= distance <= 7:
        raise ValueError("distance must be 1 to 7")
    seg = _ring(distance)
    m = len(seg)
    out = []
    for i in range(m):
        budgets, chain = [], 0
        for n in range(1, m):
            chain |= _mask(*seg[(i + n - 1) % m])
            budgets.append((chain, n * distance // m))
        for half in _parts(*seg[(i + 1) % m], 2):
            thirds = _parts(*seg[(i + 2) % m], distance + 1) if m > 2 else [0]
            out += [(_mask(*seg[i]) | half | part, budgets) for part in thirds]
    return out


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fps(fp)`` at 1 to
    ``distance`` differing bits, each once: a pair counts at the first key whose
    bits agree and whose chain keeps its budgets."""
    keys = ring_keys(distance)
    rows = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(_signed(mask)).alias("bits"))
        for t, (mask, _) in enumerate(keys)])).alias("k")).select("fp", "k.t", "k.bits")
    a = rows.select(F.col("fp").alias("a"), "t", "bits")
    b = rows.select(F.col("fp").alias("b"), F.col("t").alias("bt"), F.col("bits").alias("bbits"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    first = None
    for t, (mask, budgets) in reversed(list(enumerate(keys))):
        fits = x.bitwiseAND(_signed(mask)) == 0
        for chain, most in budgets[1:]:  # the first segment is in the key
            fits = fits & (F.bit_count(x.bitwiseAND(_signed(chain))) <= most)
        first = F.when(fits, F.lit(t)).otherwise(F.lit(-1) if first is None else first)
    cond = (F.col("t") == F.col("bt")) & (F.col("bits") == F.col("bbits")) & (F.col("a") < F.col("b")) & \
        (first == F.col("t")) & (F.bit_count(x) <= distance)
    return a.join(b, cond).select("a", "b")


def _roots(least: DataFrame, distance: int) -> tuple[DataFrame, list[str]]:
    """``least`` (one row per distinct ``fp``) with its component's ``root``."""
    roots, old = components(links(least.select("fp"), distance))
    return least.join(roots, least["fp"] == roots["node"], "left") \
        .withColumn("root", F.coalesce("root", "fp")).drop("node"), old


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       distance: int = 2) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) for each input row.

    Two rows are in one component if a chain of links (``distance`` or fewer
    differing bits) joins their fingerprints; component_id is its smallest id.
    Null or empty texts have fingerprint zero, linked like any other. Rows with a
    null id get their component's id and never name one (null if the component
    has no other). Repeated rows stay repeated; other columns are not read. An
    empty table gives an empty result.
    """
    fp, _ = write_once(df.select(F.col(id_col).alias("id"), fingerprint_column(text_col, shingle).alias("fp")), "simhash")
    least, least_path = write_once(fp.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-fp")
    member, old = _roots(least, distance)
    comp, _ = write_once(member.join(member.groupBy("root").agg(F.min("least_id").alias("component_id")), "root")
                         .select("fp", "component_id"), "simhash-comp")
    drop_path(df.sparkSession, least_path, *old)
    return fp.join(comp, "fp").select(F.col("id").alias(id_col),
                                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``df`` with one row of each component, that with the smallest
    id (of rows repeated with it, one; null ids come last); all columns stay.

    The rows are written once with their fingerprint and a row key; the keys to
    keep are looked up in one small file per group of rows, so texts are never
    shuffled, whatever the ids are."""
    spark, cols = df.sparkSession, df.columns
    rows, _ = write_once(df.withColumn("__fp", fingerprint_column(text_col, shingle))
                         .withColumn("__row", F.monotonically_increasing_id()), "simhash-rows")
    first = F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("__row").alias("row")))
    least, least_path = write_once(rows.groupBy(F.col("__fp").alias("fp")).agg(first.alias("first")), "simhash-fp")
    member, old = _roots(least, distance)
    winners = member.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    keep = write_sides(winners.withColumn("g", group_of()), "simhash-keep", "row")
    drop_path(spark, least_path, *old)

    @F.pandas_udf("boolean")
    def kept(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sides = Sides(keep)
        for keys in batches:
            k = keys.to_numpy()
            hit = np.zeros(len(k), bool)
            for g in np.unique(k >> 33):
                mine = k >> 33 == g
                hit[mine] = np.isin(k[mine], sides.load(int(g), ["row"])["row"])
            yield pd.Series(hit)

    return rows.filter(kept("__row")).select(*cols)
