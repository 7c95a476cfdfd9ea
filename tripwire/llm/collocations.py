"""Phrase collocations by direct-address tiling.

Words get ids by frequency rank. A phrase of n + 1 words is a pair of ids of two
overlapping phrases of n words, so one counter of pairs serves every length: the
pairs of two ranks are dealt to square tiles of the rank x rank plane, a crowded
tile is counted by a dense ``bincount`` over its cells, all other pairs as sorted
coordinates (COO). Pairs that are frequent enough are ranked by frequency again
and become the ids of the next length.

What is broadcast has a fixed size at every scale: the HEAD most frequent phrases
of a length with their ranks, and a bitmap of all that are frequent. A phrase
outside the head has a 62-bit hash for an id and is always counted as COO; a
phrase that the bitmap lets through by chance only adds counts that the final
threshold drops.

Texts are cut into words twice, to count them and to write their ids; every
further length reads the ids alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.llm.common import drop_path, write_once

#: Phrases of one length that have a rank.
HEAD = 1 << 18
#: Ranks on each side of a tile; the tiles of the plane are numbered by 16 bits.
TILE = 1 << 10
#: Bits of the map of the frequent phrases of one length (4 MB).
MAP_BITS = 1 << 25
#: Pairs or words held before they are counted and sent on.
HELD = 1 << 21
TAIL = np.int64(1) << np.int64(62)
_BREAKS = bytes(0xFF if chr(c) in ".,;:!?\n\x0b\x0c\r" else c for c in range(256))


def pieces(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, with ``\\xff`` between its pieces."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower().translate(_BREAKS)
    return raw.replace(b"\xff", b" \xff ").split()


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of pairs of ids."""
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    h ^= h >> np.uint64(29)
    h = (h + b.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def tail_id(h: np.ndarray) -> np.ndarray:
    """The id of a phrase outside the head: above all ranks, and positive."""
    return (h >> np.uint64(2)).astype(np.int64) | TAIL


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


class Bitmap:
    """Which hashes may belong to frequent phrases."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & np.uint64(64 * len(self.cells) - 1)
        return (self.cells[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


class Words:
    """Ids of single words: rank in the head, or hash, or -1."""

    def __init__(self, ranks: dict[str, dict[bytes, int]], bitmap: Bitmap | None):
        self.ranks, self.bitmap = ranks, bitmap  # no bitmap: all frequent words have ranks

    def ids(self, lang: str, words: list[bytes], memo: dict) -> np.ndarray:
        """The ids with one -1 for each run of gaps and rare words, and one at the end."""
        seen = memo.get(lang)
        if seen is None or len(seen) > HEAD + HELD // 2:
            seen = memo[lang] = dict(self.ranks.get(lang, {}))
        if self.bitmap is not None:
            new = [w for w in set(words) if w not in seen]
            h = word_hashes(lang, new)
            seen.update(zip(new, np.where(self.bitmap.has(h), tail_id(h), -1).tolist()))
            seen[b"\xff"] = -1
        get = seen.get
        words.append(b"\xff")
        x = np.array([get(w, -1) for w in words], np.int64)
        return x[np.r_[True, (x[1:] >= 0) | (x[:-1] >= 0)]]


class Pairs:
    """Ids of the phrases of one length from the ids of the length before."""

    def __init__(self, a: np.ndarray, b: np.ndarray, rank: np.ndarray, bitmap: Bitmap):
        h = mix(a, b)
        order = np.argsort(h)
        self.h, self.a, self.b, self.rank, self.bitmap = h[order], a[order], b[order], rank[order], bitmap

    def ids(self, at: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, ids) of the phrases that may be frequent, from those one word shorter."""
        place, a, b = adjacent(at, x)
        h = mix(a, b)
        some = np.flatnonzero(self.bitmap.has(h))
        place, a, b, h = place[some], a[some], b[some], h[some]
        near = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        head = (self.h[near] == h) & (self.a[near] == a) & (self.b[near] == b)
        return place, np.where(head, self.rank[near], tail_id(h))


def adjacent(at: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, id, next id) where phrases begin at two places in a row."""
    i = np.flatnonzero(at[1:] == at[:-1] + 1)
    return at[i], x[i], x[i + 1]


def count_pairs(a: np.ndarray, b: np.ndarray, head: int = HEAD, side: int = TILE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct pairs (a, b) with their counts: crowded tiles of two ranks by a
    dense ``bincount``, the pairs of all other tiles as sorted COO, those with a
    hash sorted by both ids."""
    ranked = (a < head) & (b < head)
    if not ranked.all():
        x, y = a[~ranked], b[~ranked]
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        yield x[first], y[first], np.diff(np.r_[first, len(x)])
        a, b = a[ranked], b[ranked]
    if not len(a):
        return
    across = -(-head // side)
    tile = (a // side * across + b // side).astype(np.uint16 if across <= 256 else np.int64)
    size = np.bincount(tile, minlength=across * across)
    crowded = size * 8 >= side * side
    sparse = ~crowded[tile]
    if sparse.any():
        code, n = np.unique(a[sparse] * head + b[sparse], return_counts=True)
        yield code // head, code % head, n
        a, b, tile = a[~sparse], b[~sparse], tile[~sparse]
    cell = (a % side * side + b % side)[np.argsort(tile, kind="stable")]  # 16-bit tiles: a radix sort
    at = 0
    for t in np.flatnonzero(crowded):
        dense = np.bincount(cell[at: at + size[t]], minlength=side * side)
        at += size[t]
        used = np.flatnonzero(dense)
        yield t // across * side + used // side, t % across * side + used % side, dense[used]


def _texts(df: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, h, f) of all words; counted in each task, then summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[str, Counter] = {}

        def flush():
            for lang, c in count.items():
                c.pop(b"\xff", None)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()).cast(pa.string()),
                    pa.array(word_hashes(lang, list(c)).view(np.int64)), pa.array(list(c.values()), pa.int64())],
                    ["lang", "word", "h", "c"])
            count.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count.setdefault(lang, Counter()).update(pieces(text))
            if sum(map(len, count.values())) > HELD // 2:
                yield from flush()
        yield from flush()

    part = docs.mapInArrow(run, "lang string, word string, h long, c long")
    return part.groupBy("lang", "word", "h").agg(F.sum("c").alias("f"))


def word_ids(docs: DataFrame, words) -> DataFrame:
    """(ids): the word ids of each text, -1 between pieces and at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, memo = words.value, {}
        for batch in batches:
            found = [table.ids(lang, pieces(text), memo) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            ends = np.cumsum([0, *map(len, found)])
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*found, np.empty(0, np.int64)])))], ["ids"])

    return docs.mapInArrow(run, "ids array<long>")


def count_next(ids: DataFrame, steps: list, head: int, side: int) -> DataFrame:
    """(a, b, f): the pairs of overlapping phrases of the length that ``steps`` reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = [s.value for s in steps]
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            if held:
                for a, b, n in count_pairs(*(np.concatenate(x) for x in zip(*held)), head, side):
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "c"])
            held.clear()

        for batch in batches:
            flat = batch.column(0).flatten().to_numpy()
            for k in range(0, len(flat), HELD):
                x = flat[k: k + HELD + len(steps) + 1]  # as many places more as a phrase that begins before them has
                at = np.flatnonzero(x >= 0)
                x = x[at]
                for step in chain:
                    at, x = step.ids(at, x)
                at, a, b = adjacent(at, x)
                mine = np.searchsorted(at, HELD)
                held.append((a[:mine], b[:mine]))
                size += mine
                if size > HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    return ids.mapInArrow(run, "a long, b long, c long").groupBy("a", "b").agg(F.sum("c").alias("f"))


def _bitmap(known: DataFrame) -> Bitmap:
    """The bitmap of all phrases, put together by bit_or: at most MAP_BITS / 64
    rows reach the driver."""
    at = F.col("h").bitwiseAND(MAP_BITS - 1)
    got = known.groupBy(F.shiftright(at, 6).alias("cell")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(h & 63L AS INT))")).alias("bits")).collect()
    cells = np.zeros(MAP_BITS // 64, np.int64)
    for r in got:
        cells[r.cell] = r.bits
    return Bitmap(cells.view(np.uint64))


def _pair_hash(a: str, b: str) -> Column:
    @F.pandas_udf("long")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(mix(x.to_numpy(), y.to_numpy()).view(np.int64))

    return run(a, b)


def _id():
    """Rank, or what ``tail_id`` gives for the hash."""
    return F.coalesce("rank", F.shiftrightunsigned("h", 2).bitwiseOR(F.lit(int(TAIL)))).alias("id")


def collocations(df: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 100,
                 longest: int = 5, top: int = 2000, head: int = HEAD, tile: int = TILE) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``longest`` words:
    (lang, rank, phrase, a, l, r, n, score).

    Texts have A-Z lower-cased and are split at ``.,;:!?`` and U+000A to U+000D
    into pieces, those at spaces and tabs into words; null texts are empty, a null
    language is ``und``. n counts all word occurrences of the language, a all
    occurrences of the phrase within pieces, overlaps included (at least
    ``min_count``). Cut after k words, l and r are the counts of its parts, and
    the score floor(1000 * a * n / (l * r)) in exact decimals; the lowest cut
    counts, at equal scores that with the smallest k. A phrase that a longer one
    of the same count contains is dropped (a longer phrase is never more frequent,
    so it is enough to look at those one word longer). Order: score, then a, both
    falling, then the phrase by its UTF-8 bytes. Repeated rows count as often as
    they occur; other columns are not read; an empty table gives an empty result.

    Tasks send distinct pairs with counts, so
    a word or phrase that a third of all places hold is one row per task. ``head``
    phrases of a length have ranks, ``tile`` of them on a side of a tile; both
    change the cost and not the result.
    """
    if min_count < 1 or longest < 2:
        raise ValueError("min_count must be at least 1 and longest at least 2")
    spark, old, found, steps = df.sparkSession, [], [], []

    def written(table: DataFrame, name: str) -> DataFrame:
        table, path = write_once(table, name)
        old.append(path)
        return table

    def ranked(table: DataFrame, *key: str) -> list:  # all that is ever collected of phrases
        return table.orderBy(F.col("f").desc(), *key).limit(head).collect()

    docs = _texts(df, lang_col, text_col)
    counted = written(count_words(docs), "words")
    if counted.groupBy(F.shiftrightunsigned("h", 2)).count().filter("count > 1").limit(1).count():
        raise RuntimeError("two words share a hash; change the seed of word_hashes")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counted.filter(F.col("f") >= min_count)
    first = ranked(frequent, "lang", "word")
    ids = spark.createDataFrame([(i, r.lang, r.word) for i, r in enumerate(first)], "rank long, lang string, word string")
    none = F.array().cast("array<long>")
    known = written(frequent.join(ids, ["lang", "word"], "left").select(
        _id(), "rank", "h", "lang", "f", F.col("word").alias("phrase"), F.col("word").alias("last"),
        none.alias("fronts"), none.alias("backs")), "phrases")
    ranks: dict[str, dict[bytes, int]] = {}
    for i, r in enumerate(first):
        ranks.setdefault(r.lang, {})[r.word.encode("utf-8", "surrogatepass")] = i
    places = written(word_ids(docs, spark.sparkContext.broadcast(Words(ranks, _bitmap(known) if len(first) == head else None))), "ids")

    for n in range(2, longest + 1):
        pairs = written(count_next(places, steps, head, tile).filter(F.col("f") >= min_count), "pairs")
        first = ranked(pairs, "a", "b")
        if not first:
            break
        ids = spark.createDataFrame([(i, r.a, r.b) for i, r in enumerate(first)], "rank long, a long, b long")
        left = known.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("front"), "fronts", F.col("f").alias("fa"))
        right = known.select(F.col("id").alias("b"), "last", "backs", F.col("f").alias("fb"))
        known = written(pairs.join(left, "a").join(right, "b").join(ids, ["a", "b"], "left").withColumn("h", _pair_hash("a", "b")).select(
            _id(), "rank", "h", "lang", "f", F.concat_ws(" ", "front", "last").alias("phrase"), "last",
            F.concat("fronts", F.array("fa")).alias("fronts"), F.concat("backs", F.array("fb")).alias("backs"), "a", "b"), "phrases")
        found.append(known)
        if n < longest:
            a, b, rank = (np.array(x, np.int64) for x in zip(*((r.a, r.b, i) for i, r in enumerate(first))))
            steps.append(spark.sparkContext.broadcast(Pairs(a, b, rank, _bitmap(known))))

    kept = spark.createDataFrame([], "lang string, phrase string, a long, fronts array<long>, backs array<long>")
    for level, longer in zip(found, [*found[1:], None]):
        if longer is not None:
            inside = longer.select(F.col("a").alias("id"), "f").union(longer.select(F.col("b").alias("id"), "f"))
            level = level.join(inside.distinct(), ["id", "f"], "left_anti")
        kept = kept.union(level.select("lang", "phrase", F.col("f").alias("a"), "fronts", "backs"))
    out, _ = write_once(_scores(kept.join(totals, "lang"), top), "collocations")
    drop_path(spark, *old)
    return out


def _scores(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language: first within parts of a language, then of those that are left."""
    cut = F.expr("""transform(sequence(1, size(fronts)), k -> struct(
        (CAST(1000 * a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0))) div (CAST(fronts[k - 1] AS DECIMAL(19, 0)) * CAST(backs[size(fronts) - k] AS DECIMAL(19, 0))) AS score,
        k, fronts[k - 1] AS l, backs[size(fronts) - k] AS r))""")
    best = phrases.withColumn("cut", F.array_min(cut)).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    near = best.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))) \
        .filter(F.col("rank") <= top).drop("rank", "part")
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
