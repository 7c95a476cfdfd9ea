"""Near-duplicates by circulant MinHash.

A document's set is its distinct word shingles, as 64-bit hashes. Two permutations
of 32-bit numbers give all coordinates of a signature: the first scatters the set,
the second is applied to the scattered set shifted by k (mod 2^32), and coordinate
k is the least value. Coordinates are banded; sets that share a band are candidates,
and a candidate pair is a link only if the full sets say so.

Work is on different sets: copies are one node before the search. Nodes that chains
of shared buckets join are a group, so linked sets are in one group. A group's sets
are dealt to parts, and each two parts meet in a block that counts the shared shingles
of all its pairs at once; only links leave it, no pair is ever a row. A set is sent
once to each part of its group, not once to each candidate. Groups with too many pairs
go to bands twice as long, which join fewer of the sets that are not similar; the same
two permutations give as many coordinates as it takes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm.common import Sides, components, drop_path, group_of, slim_rows, write_once, write_sides

#: Chance that a pair at the limit shares no band.
MISS = 1e-7
#: Coordinates to a band, at first and for groups with too many pairs.
BAND_ROWS = (5, 10, 20)
#: Pairs that a group may have, of bands of each length but the last; the nodes of groups with more go to the next length.
GROUP_PAIRS = (1 << 28, 1 << 34)
#: Sets that a part of a group is made for, in up to PARTS parts; sets and shingles that a part may have on average.
PART_SETS, PARTS, MOST_SETS, MOST_SHINGLES = 64, 32, 1024, 1 << 21
#: Shingles whose sets are counted at a time.
SLAB = 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word) - (1 << 63)
        return h


def shingle_set(raw: bytes, size: int, memo: WordHashes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the ``size``-word shingles of a text with
    A-Z lower-cased; with fewer words one of the whole sequence, without words none."""
    words = raw.lower().split()
    if len(memo) > 1 << 20:
        memo.clear()
    w = np.fromiter(map(memo.__getitem__, words), np.int64, len(words)).view(np.uint64)
    k = min(size, len(w))
    if not k:
        return w
    h = np.full(len(w) - k + 1, k, np.uint64)
    for j in range(k):
        h = h * _BASE + w[j: len(w) - k + 1 + j]
    return np.unique(h)


def bands_for(rows: int, limit: float) -> int:
    """Bands of ``rows`` coordinates that a pair with Jaccard similarity ``limit`` misses with chance MISS."""
    return math.ceil(math.log(MISS) / math.log1p(-limit ** rows))


def signature(h: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` coordinates of a set."""
    x = (h ^ (h >> np.uint64(32))).astype(np.uint32)  # the first permutation: murmur's finaliser
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(16)
    out = np.full(k, 0xFFFFFFFF, np.uint32)
    step = 512
    held = np.empty((min(k, step), min(len(x), step)), np.uint32)
    for c in range(0, k, step):
        shifts = np.arange(c, min(k, c + step), dtype=np.uint32)[:, None]
        for i in range(0, len(x), step):
            y = x[i: i + step] + shifts  # circular in 32 bits
            y *= np.uint32(0x7FEB352D)  # the second permutation
            y ^= np.right_shift(y, np.uint32(15), out=held[: y.shape[0], : y.shape[1]])
            y *= np.uint32(0x846CA68B)
            out[c: c + step] = np.minimum(out[c: c + step], y.min(axis=1))
    return out


def band_keys(h: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key per band."""
    sig = signature(h, rows * bands).reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(rows)
    for j in range(rows):
        key = (key ^ sig[:, j]) * _BASE
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate([*arrays, np.empty(0, np.int64)]).astype(np.int64)))


def _signed(rows: DataFrame, size: int, limit: float) -> DataFrame:
    """(row, id, n, key, bands): set size, 128-bit name of the set, band keys."""
    kind = rows.schema["id"].dataType.simpleString()
    width, bands = BAND_ROWS[0], bands_for(BAND_ROWS[0], limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            n, keys, found = [], [], []
            for raw in batch.column("raw"):
                h = shingle_set(raw.as_py(), size, memo)
                n.append(len(h))
                keys.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                found.append(band_keys(h, width, bands) if len(h) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), _lists(found)],
                                             ["row", "id", "n", "key", "bands"])

    return rows.mapInArrow(run, f"row long, id {kind}, n long, key binary, bands array<long>")


def _chosen(texts: DataFrame, side: str, size: int, more: list[str], out: Callable, schema: str) -> DataFrame:
    """``out(rows, sets, {name: values})`` for the rows in the side files with their columns ``more``; texts are not shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, sides = WordHashes(), Sides(side)
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for g in np.unique(rows >> 33):
                held = sides.load(int(g), ["row", *more])
                mine = np.nonzero((rows >> 33 == g) & np.isin(rows, held["row"]))[0]
                if len(mine):
                    at = np.searchsorted(held["row"], rows[mine])
                    sets = [shingle_set(batch.column("raw")[int(i)].as_py(), size, memo) for i in mine]
                    yield from out(rows[mine], sets, {c: held[c][at] for c in more})

    return texts.select("row", "raw").mapInArrow(run, schema)


def _sets(texts: DataFrame, side: str, size: int) -> DataFrame:
    """(root, parts, node, set) of the rows in the side files."""
    def out(rows: np.ndarray, sets: list, more: dict) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(more["root"]), pa.array(more["parts"]), pa.array(rows), _lists([h.view(np.int64) for h in sets])],
                                         ["root", "parts", "node", "set"])

    return _chosen(texts, side, size, ["root", "parts"], out, "root long, parts long, node long, set array<long>")


def _longer(texts: DataFrame, side: str, size: int, width: int, bands: int) -> DataFrame:
    """(node, b): the keys of longer bands of the rows in the side files."""
    def out(rows: np.ndarray, sets: list, _) -> Iterator[pa.RecordBatch]:
        for node, h in zip(rows.tolist(), sets):
            yield pa.RecordBatch.from_arrays([pa.array([node] * bands, pa.int64()), pa.array(band_keys(h, width, bands))], ["node", "b"])

    return _chosen(texts, side, size, [], out, "node long, b long")


def shared_counts(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many values each two of the sets share (the sets one after another in ``values``)."""
    both = np.zeros((len(sizes), len(sizes)), np.float32)
    if not len(values):
        return both
    order = np.argsort(values, kind="stable")
    v, row = values[order], np.repeat(np.arange(len(sizes)), sizes)[order]
    same = v[1:] == v[:-1]
    several = np.r_[False, same] | np.r_[same, False]  # values of one set alone are shared by none
    v, row = v[several], row[several]
    col = np.cumsum(np.r_[False, v[1:] != v[:-1]]) if len(v) else row
    for c in range(0, int(col[-1]) + 1 if len(col) else 0, SLAB):
        lo, hi = np.searchsorted(col, [c, c + SLAB])
        m = np.zeros((len(sizes), int(col[hi - 1]) + 1 - c), np.float32)
        m[row[lo:hi], col[lo:hi] - c] = 1
        both += m @ m.T
    return both


def _linked(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links (a, b) that join what is similar in a block of sets: each node and the least one that a chain in the block reaches."""
    def run(block: pa.Table) -> pa.Table:
        block = block.select(["node", "set"]).sort_by("node")
        node, sets = block["node"].to_numpy(), pa.concat_arrays(block["set"].chunks)
        sizes = np.diff(sets.offsets.to_numpy())
        both = shared_counts(sets.flatten().to_numpy(), sizes).astype(np.int64)
        near = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
        np.fill_diagonal(near, True)
        label, before = np.arange(len(node)), None
        while before is None or (label != before).any():
            before = label
            label = np.where(near, label[None, :], len(node)).min(axis=1)
            label = label[label]
        far = label != np.arange(len(node))
        return pa.table({"a": pa.array(node[far]), "b": pa.array(node[label[far]])})

    return run


def _blocks(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of sets in the same group; each two parts of a group are one block."""
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    met = sets.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))) \
        .filter("other <> part or parts = 1")
    return met.select("root", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node", "set") \
        .groupBy("root", "i", "j").applyInArrow(_linked(percent), "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 85,
                    bucket_pairs: tuple[int, ...] = GROUP_PAIRS, hubs: tuple[int, ...] = ()) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each input row.

    A text's set: its distinct ``shingle``-word shingles, A-Z lower-cased, words
    between space and U+0009 to U+000D; with fewer words the whole sequence. Rows
    are linked if 100 * intersection >= ``percent`` * union of their full sets;
    component_id is the smallest id that a chain of links reaches. Null, empty and
    blank texts have no set and no link (component_id: the own id). Rows with a null
    id get their component's id and never name one. ``kept``: the id is the
    component's, so repeated rows of one id are all kept. Other columns are not
    read. An empty table gives an empty result.

    A pair at the limit is no candidate with chance MISS; of the pairs in a group
    of buckets none is left out (see the module). ``bucket_pairs``: pairs that a group
    may have before it goes to longer bands. ``hubs`` (rounds of hubs) is taken for
    older callers and has no effect: all pairs of a group are counted. Links are
    decided on 64-bit hashes of shingles.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must be 1 to 100")
    limit, old, links = percent / 100, [], None

    def written(table: DataFrame, name: str) -> DataFrame:
        table, path = write_once(table, f"minhash-{name}")
        old.append(path)
        return table

    texts, texts_path = slim_rows(df, id_col, text_col, "minhash-texts")
    old.append(texts_path)
    signed, _ = write_once(_signed(texts, shingle, limit), "minhash")
    nodes = written(signed.filter("n > 0").groupBy("key").agg(
        F.min("row").alias("node"), F.min("id").alias("least_id"), F.first("n").alias("n"), F.first("bands").alias("bands")), "nodes")
    keys = nodes.select("node", F.explode("bands").alias("b"))
    for wider, most in zip((*BAND_ROWS[1:], None), (*bucket_pairs, None)):
        least = keys.groupBy("b").agg(F.min("node").alias("least"), F.max("node").alias("last")).filter("least <> last").select("b", "least")
        group, paths = components(keys.join(least, "b").filter("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")))
        old += paths
        m, n = F.count("*"), F.sum("n")
        parts = F.greatest(F.ceil(n / MOST_SHINGLES), F.ceil(m / MOST_SETS), F.least(F.lit(PARTS), F.ceil(m / PART_SETS)))
        crowded = m * (m - 1) / 2 > most if most else F.lit(False)
        size = written(group.join(nodes.select("node", "n"), "node").groupBy("root").agg(parts.cast("long").alias("parts"), crowded.alias("crowded")), "groups")
        dealt = group.join(size, "root").select(F.col("node").alias("row"), "root", "parts", "crowded").withColumn("g", group_of())
        old.append(side := write_sides(dealt.filter("not crowded").drop("crowded"), "minhash-dealt", "row"))
        found = written(_blocks(_sets(texts, side, shingle), percent), "links")
        links = found if links is None else links.union(found)
        if not wider or not size.filter("crowded").limit(1).count():
            break
        old.append(side := write_sides(dealt.filter("crowded").select("row", "g"), "minhash-crowded", "row"))
        keys = written(_longer(texts, side, shingle, wider, bands_for(wider, limit)), "buckets")
    roots, paths = components(links)
    old += paths
    least = written(roots.join(nodes.select("node", "least_id"), "node").groupBy("root").agg(F.min("least_id").alias("component_id")), "least")
    comp, _ = write_once(nodes.select("key", "node", "least_id").join(roots.join(least, "root").select("node", "component_id"), "node", "left")
                         .select("key", F.coalesce("component_id", "least_id").alias("component_id")), "minhash-comp")
    drop_path(signed.sparkSession, *old)
    out = signed.select("id", "n", "key").join(comp, "key", "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
