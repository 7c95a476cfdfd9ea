"""Suffix-array deduplication of byte strings.

Every byte that a ``length``-byte string covers which also starts anywhere else
is removed. The suffixes are sorted on their first ``length`` bytes by a
difference-cover scheme whose cover is chosen by content:

1. Sample. The cover of a text has, for every start x, the position p(x) in
   [x, x + length / 2] whose (length / 2)-byte string has the least hash (the
   leftmost). Two equal ``length``-byte strings hold their sampled position at
   the same offset, which is what a difference cover is for; but only about
   4 in ``length`` positions are sampled instead of 2 in 3. (Such covers are
   known as string synchronizing sets; Kempa and Kociumaka, 2019.)
2. Sort sampled triples and name them. A sampled suffix is the triple (bytes
   before it, its anchor string, bytes after it) over all starts that sample
   it. Anchors that occur once in all texts start no repeat and go; equal
   triples get one name (128 bits). A name spans at least ``length`` bytes, so
   the recursion on names ends after this level. Starts whose triple occurs
   twice are repeats.
3. Merge the remaining suffixes. Triples that share their anchor with another,
   but are equal to none, are expanded: a start x is the pair (offset back
   from the sample, sampled suffix). Only one triple of each name takes part.
4. Compare adjacent prefixes. The expanded suffixes of one anchor and offset
   are sorted, and neighbours with equal prefixes of ``length`` bytes repeat.

An anchor with more than HOT different triples (a passage that a large share of
all texts hold) is not sorted in one task: ranges of its suffixes are named,
counted over all tasks with a map-side combine, and halved where undecided.

Texts are written once with a row key; later scans look their rows up in one
file per group of rows, so no text is shuffled. Only hashes of anchors, names
of triples, and the bytes around unresolved triples are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm.common import Sides, drop_path, group_of, slim_rows, write_once, write_sides

LENGTH = 200
#: Starts of one text handled at once (bounds the arrays of a very long text).
BLOCK = 1 << 21
#: Different triples of an anchor that one task may sort.
HOT = 1000
_BASE = 0x9E3779B97F4A7C15 | 1


def window_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n bytes from each position, by doubling."""
    power = data.astype(np.uint64) + np.uint64(0x51ED2701)
    size, out, done = 1, None, 0
    while True:
        if n & size:
            if out is None:
                out = power.copy()
            else:
                m = len(power) - done
                out = out[:m] * np.uint64(pow(_BASE, size, 1 << 64)) + power[done:]
            done += size
        if 2 * size > n:
            break
        m = len(power) - size
        power = power[:m] * np.uint64(pow(_BASE, size, 1 << 64)) + power[size:]
        size *= 2
    out = out[: len(data) - n + 1]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out


def sampled(raw: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (p, first, last, hash): the starts first..last sample position p,
    whose anchor string has this hash."""
    half = length // 2
    reach = length - half + 1  # anchors inside a window
    for at in range(0, len(raw) - length + 1, BLOCK):
        data = np.frombuffer(raw, np.uint8, min(BLOCK + length - 1, len(raw) - at), at)
        h = window_hashes(data, half)
        # upper hash bits, then the position: the least is the leftmost of the least hashes
        key = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= reach:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < reach:
            key = np.minimum(key[: len(key) - (reach - size)], key[reach - size:])
        p = (key & np.uint64((1 << 24) - 1)).astype(np.int64)
        edge = np.concatenate([[0], np.nonzero(np.diff(p))[0] + 1, [len(p)]])
        first, last, p = edge[:-1], edge[1:] - 1, p[edge[:-1]]
        yield p + at, first + at, last + at, h[p]


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for b in batches:
        raw = b.column(1)
        for i, row in enumerate(b.column(0).to_pylist()):
            yield row, raw[i].as_buffer().to_pybytes()


def _flush(cols: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(cols[f.name]) if cols[f.name] else [], f.type) for f in schema], schema=schema)
    for c in cols.values():
        c.clear()
    return out


ANCHORS = pa.schema([("anchor", pa.int64()), ("g", pa.int32()), ("n", pa.int64())])
TRIPLES = pa.schema([("anchor", pa.int64()), ("n1", pa.int64()), ("n2", pa.int64()), ("row", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("p", pa.int64())])
STARTS = pa.schema([("row", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
_types = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.bool_(): "boolean", pa.string(): "string"}


def _ddl(s: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_types[f.type]}" for f in s)


def _repeated_anchors(slim: DataFrame, length: int) -> str:
    """Side files (g, anchor) of the anchors that occur twice or more."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols, held, group = {f.name: [] for f in ANCHORS}, 0, None
        pending: list[np.ndarray] = []

        def settle() -> None:
            nonlocal held
            if pending:
                a, n = np.unique(np.concatenate(pending), return_counts=True)
                cols["anchor"].append(_signed(a))
                cols["g"].append(np.full(len(a), group, np.int32))
                cols["n"].append(n.astype(np.int64))
                pending.clear()
            held = 0

        for row, raw in _rows(batches):
            if row >> 33 != group or held > 1 << 20:
                settle()
                if cols["g"]:
                    yield _flush(cols, ANCHORS)
                group = row >> 33
            for _, _, _, h in sampled(raw, length):
                pending.append(h)
                held += len(h)
        settle()
        yield _flush(cols, ANCHORS)

    seen, path = write_once(slim.select("row", "raw").mapInArrow(scan, _ddl(ANCHORS)), "suffix-seen")
    twice = seen.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")
    out = write_sides(seen.select("anchor", "g").join(twice, "anchor").distinct(), "suffix-anchors", "anchor")
    drop_path(slim.sparkSession, path)
    return out


def _triples(slim: DataFrame, anchors: str, length: int) -> DataFrame:
    """The sampled triples of repeated anchors: their name and the starts they stand for."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, cols, held = Sides(anchors), {f.name: [] for f in TRIPLES}, 0
        for row, raw in _rows(batches):
            wanted = sides.load(row >> 33, ["anchor"])["anchor"]
            if not len(wanted):
                continue
            for p, first, last, h in sampled(raw, length):
                a = _signed(h)
                at = np.minimum(np.searchsorted(wanted, a), len(wanted) - 1)
                keep = np.nonzero(wanted[at] == a)[0]
                if not len(keep):
                    continue
                p, first, last, a = p[keep], first[keep], last[keep], a[keep]
                names = b"".join([xxhash.xxh3_128_digest(raw[x:y]) for x, y in zip(first.tolist(), (last + length).tolist())])
                n = np.frombuffer(names, "<i8").reshape(-1, 2)
                for c, v in zip(TRIPLES.names, (a, n[:, 0], n[:, 1], np.full(len(a), row, np.int64), first, last, p)):
                    cols[c].append(v)
                held += len(a)
            if held > 1 << 17:
                yield _flush(cols, TRIPLES)
                held = 0
        yield _flush(cols, TRIPLES)

    return slim.select("row", "raw").mapInArrow(scan, _ddl(TRIPLES))


CONTEXT = pa.schema([("anchor", pa.int64()), ("hot", pa.bool_()), ("single", pa.bool_()), ("row", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
                     ("p", pa.int64()), ("context", pa.binary())])


def _contexts(slim: DataFrame, sides_path: str, length: int) -> DataFrame:
    """The bytes of the triples that the side files list."""
    want = ["row", "anchor", "hot", "single", "first", "last", "p"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, out, held = Sides(sides_path), [], 0
        for row, raw in _rows(batches):
            t = sides.load(row >> 33, want)
            a, b = np.searchsorted(t["row"], [row, row + 1])
            for i in range(a, b):
                first, last = int(t["first"][i]), int(t["last"][i])
                out.append((int(t["anchor"][i]), bool(t["hot"][i]), bool(t["single"][i]), row, first, last, int(t["p"][i]), raw[first: last + length]))
                held += last + length - first
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), CONTEXT)], schema=CONTEXT)
                out, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(CONTEXT)], schema=CONTEXT)

    return slim.select("row", "raw").mapInArrow(scan, _ddl(CONTEXT))


def adjacent_repeats(members: list[tuple], length: int) -> list[tuple[int, int, int]]:
    """(row, first, last) of repeated starts of single triples of one anchor.

    members: (single, row, first, last, p, context). For each offset back from
    the sample, the suffixes of the members that have it are sorted, and
    neighbours compared on ``length`` bytes."""
    found: dict[int, list[int]] = {}
    least = min(m[4] - m[3] for m in members)
    most = max(m[4] - m[2] for m in members)
    for back in range(least, most + 1):
        suffixes = []
        for i, (_, _, first, last, p, context) in enumerate(members):
            x = p - back
            if first <= x <= last:
                suffixes.append((context[x - first: x - first + length], i))
        suffixes.sort()
        for (s, i), (t, j) in zip(suffixes, suffixes[1:]):
            if s == t:
                for k in (i, j):
                    if members[k][0]:
                        found.setdefault(k, []).append(members[k][4] - back)
    out = []
    for k, starts in found.items():
        x = np.unique(np.array(starts))
        cut = np.concatenate([[0], np.nonzero(np.diff(x) > 1)[0] + 1, [len(x)]])
        out += [(members[k][1], int(x[a]), int(x[b - 1])) for a, b in zip(cut, cut[1:])]
    return out


def _merge(contexts: DataFrame, length: int) -> DataFrame:
    """Steps 3 and 4 for all anchors but hot ones: (row, first, last) of repeated starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, members, out = None, [], []
        for b in batches:
            for a, *m in zip(*(c.to_pylist() for c in b.columns)):
                if a != anchor:
                    if len(members) > 1:
                        out += adjacent_repeats(members, length)
                    anchor, members = a, []
                members.append(tuple(m))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(STARTS)], schema=STARTS)
            out = []
        if len(members) > 1:
            out = adjacent_repeats(members, length)
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(STARTS)], schema=STARTS)

    cool = contexts.filter("NOT hot").select("anchor", "single", "row", "first", "last", "p", "context")
    return cool.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _ddl(STARTS))


PIECES = pa.schema([("anchor", pa.int64()), ("node", pa.int64()), ("single", pa.bool_()), ("row", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
                    ("p", pa.int64()), ("context", pa.binary()), ("low", pa.int64()), ("high", pa.int64()),
                    ("i1", pa.int64()), ("i2", pa.int64()), ("u1", pa.int64()), ("u2", pa.int64())])


def _pieces(rows: DataFrame, size: int, length: int) -> DataFrame:
    """Name the suffixes of each triple whose offset back from the sample lies in
    [node * size, node * size + size): i, what all of them have in common, and
    u, all that they cover together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for anchor, node, single, row, first, last, p, context in zip(*(c.to_pylist() for c in b.columns)):
                low, high = max(p - last, node * size), min(p - first, node * size + size - 1)
                if low > high:
                    continue
                at = p - first
                common = xxhash.xxh3_128_digest(context[at - node * size: at - (node * size + size - 1) + length])
                cover = xxhash.xxh3_128_digest(context[at - high: at - low + length])
                out.append((anchor, node, single, row, first, last, p, context, low, high, *np.frombuffer(common + cover, "<i8").tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(PIECES)], schema=PIECES)

    return rows.select("anchor", "node", "single", "row", "first", "last", "p", "context").mapInArrow(run, _ddl(PIECES))


def _merge_hot(contexts: DataFrame, length: int) -> tuple[DataFrame, list[str]]:
    """The same for hot anchors, by halving ranges of offsets instead of sorting
    every suffix in one task; and the folders to drop after use.

    A triple's range is a repeat as a whole if another triple covers the same
    bytes, and holds none if no other has its common bytes. Only ranges that are
    neither are halved, which are those at the ends of a passage: a row or two
    for each triple and level. Triples with equal cover go on as one."""
    hot, path = write_once(contexts.filter("hot").withColumn("node", F.lit(0).cast("long")), "suffix-hot")
    found, paths = hot.select("row", "first", "last").limit(0), [path]
    if hot.isEmpty():
        return found, paths
    size = 1 << (length // 2).bit_length()
    rows = hot
    while True:
        named = _pieces(rows, size, length)
        cover = ["anchor", "node", "low", "high", "u1", "u2"]
        named, n_path = write_once(named, "suffix-pieces")
        same = named.groupBy(*cover).agg(F.count("*").alias("n"), F.min(F.struct("row", "first")).alias("one"))
        marked, m_path = write_once(named.join(same, cover), "suffix-marked")
        drop_path(hot.sparkSession, n_path)
        paths.append(m_path)
        found = found.union(marked.filter("single AND n > 1").select("row", (F.col("p") - F.col("high")).alias("first"), (F.col("p") - F.col("low")).alias("last")))
        if size == 1:
            return found, paths
        live = marked.filter((F.col("one.row") == F.col("row")) & (F.col("one.first") == F.col("first"))).withColumn("single", F.expr("single AND n = 1"))
        common = ["anchor", "node", "i1", "i2"]
        open_ = live.groupBy(*common).agg(F.count("*").alias("m"), F.max("single").alias("any")).filter("m > 1 AND any").select(*common)
        rows = live.join(open_, common).withColumn("node", F.explode(F.array(2 * F.col("node"), 2 * F.col("node") + 1)))
        size //= 2


def repeated_starts(slim: DataFrame, length: int = LENGTH) -> tuple[str, list[str]]:
    """Side files (g, row, first, last) of the starts whose ``length`` bytes start
    anywhere else too; and the scratch folders to drop after use."""
    spark = slim.sparkSession
    anchors = _repeated_anchors(slim, length)
    triples, t_path = write_once(_triples(slim, anchors, length), "suffix-triples")
    name = ["anchor", "n1", "n2"]
    # starts of one name are the same suffixes wherever the name occurs, but a run may be cut by a block of a long text
    names, n_path = write_once(triples.groupBy(*name).agg(
        F.count("*").alias("n"), F.min(F.struct("row", "first", "last", "p")).alias("r")), "suffix-names")
    twice = triples.join(names.filter("n > 1").select(*name), name).select("row", "first", "last")
    groups = names.groupBy("anchor").agg(F.count("*").alias("m"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("singles")) \
        .filter("m > 1 AND singles > 0").select("anchor", (F.col("m") > HOT).alias("hot"))
    open_ = names.join(groups, "anchor").select(
        group_of("r.row").alias("g"), "r.row", "r.first", "r.last", "r.p", "anchor", "hot", (F.col("n") == 1).alias("single"))
    open_path = write_sides(open_, "suffix-open", "row", "first")
    contexts, c_path = write_once(_contexts(slim, open_path, length), "suffix-contexts")
    hot, hot_paths = _merge_hot(contexts, length)
    found = twice.union(_merge(contexts, length)).union(hot)
    out = write_sides(found.withColumn("g", group_of()), "suffix-starts", "row", "first")
    drop_path(spark, anchors, t_path, n_path, open_path, c_path, *hot_paths)
    return out, [out]


def removed_runs(first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Maximal runs [a, b) of bytes covered by the strings from the starts first..last (sorted by first)."""
    if not len(first):
        return np.empty((0, 2), np.int64)
    end = np.maximum.accumulate(last + length)
    new = np.concatenate([[True], first[1:] > end[:-1]])
    at = np.nonzero(new)[0]
    return np.stack([first[at], end[np.concatenate([at[1:] - 1, [len(first) - 1]])]], axis=1)


def kept_bytes(raw: bytes, runs: np.ndarray) -> bytes:
    edges = [0, *runs.ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def whole_characters(raw: bytes, runs: np.ndarray) -> np.ndarray:
    """The runs shrunk to whole characters: one that is only partly covered stays."""
    out = []
    for a, b in runs.tolist():
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        if b < len(raw) and raw[b] & 0xC0 == 0x80:
            while b > a and raw[b] & 0xC0 == 0x80:
                b -= 1
        if a < b:
            out.append((a, b))
    return np.array(out, np.int64).reshape(-1, 2)


def _runs_of(sides: Sides, row: int, length: int) -> np.ndarray:
    t = sides.load(row >> 33, ["row", "first", "last"])
    a, b = np.searchsorted(t["row"], [row, row + 1])
    return removed_runs(t["first"][a:b], t["last"][a:b], length)


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """Per input row: id, n_bytes, n_removed, n_spans (maximal removed runs) and
    kept_sha256, and with ``with_text`` the kept bytes.

    A byte is removed if a ``length``-byte string that covers it also starts
    anywhere else, in the same text or another; all are judged on the input.
    Null texts are empty; texts shorter than ``length`` keep all. Repeated rows
    are repeats of each other; null ids stay. Other columns are not read. An
    empty table gives an empty result.
    """
    slim, _ = slim_rows(df, id_col, text_col, "suffix-texts")
    starts, _ = repeated_starts(slim, length)
    out_schema = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
    fields = list(out_schema)[: 5 if with_text else 4]
    id_type = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides(starts)
        for b in batches:
            rows = []
            for row, raw in _rows([b.select(["row", "raw"])]):
                runs = _runs_of(sides, row, length)
                kept = kept_bytes(raw, runs)
                rows.append((len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields))], ["id", *(f.name for f in fields)])

    return slim.select("row", "raw", "id").mapInArrow(run, f"id {id_type}, {_ddl(pa.schema(fields))}").withColumnRenamed("id", id_col)


def drop_repeats(df: DataFrame, text_col: str = "text", length: int = LENGTH, n_chars_col: str | None = "n_chars") -> DataFrame:
    """``df`` without the repeated bytes of its texts; all columns stay, and
    ``n_chars_col``, if it is there, counts the characters left. A character that
    is only partly covered is kept whole; null texts stay null."""
    keyed, _ = write_once(df.withColumn("__row", F.monotonically_increasing_id()), "suffix-rows")
    slim = keyed.select(F.col("__row").alias("row"), F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8").alias("raw"))
    starts, _ = repeated_starts(slim, length)

    @F.pandas_udf("string")
    def clean(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        sides = Sides(starts)
        for rows, texts in batches:
            out = []
            for row, text in zip(rows, texts):
                if text is not None:
                    raw = text.encode("utf-8", "surrogatepass")
                    text = kept_bytes(raw, whole_characters(raw, _runs_of(sides, row, length))).decode("utf-8", "surrogatepass")
                out.append(text)
            yield pd.Series(out, dtype=object)

    out = keyed.withColumn(text_col, clean(F.col("__row"), F.col(text_col).cast("string")))
    if n_chars_col in df.columns:
        out = out.withColumn(n_chars_col, F.char_length(text_col).cast(df.schema[n_chars_col].dataType))
    return out.select(*df.columns)
