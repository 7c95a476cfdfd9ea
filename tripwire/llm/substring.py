"""Substring deduplication over words with suffix automata of reference shards.

A window is ``window`` consecutive words of one document; a window whose words
also start in a document with a smaller id is removed. Every document is
reference for the later ones, so the references are all documents, far beyond
one automaton, and streaming all documents through every shard's automaton would
grow with the square of the input. Both sides are routed to shards instead:

1. Of the GRAM-word strings of a window the one with the least hash is its
   anchor; equal windows have equal anchors. Anchors within one document only
   (or of one id) start no removal and go.
2. Consecutive windows with one anchor form a span. Equal spans get one name
   (128 bits); all but those of the smallest id are removed as a whole.
3. The spans of the smallest id of each name take part in the rest, routed by anchor.
   Each task builds the suffix automaton of a bounded shard of reference spans,
   where every state keeps the smallest id of its occurrences, and streams the
   spans through it: the matching statistic at each word gives the state of the
   last ``window`` words, and a smaller id there removes the window.
4. Removed windows are joined to maximal spans of words, which are cut out.

An anchor with more than HOT different spans is not given to one task: its
windows are named, and the smallest id of each name is found by a map-side
combined aggregation. Texts are never shuffled (see ``common.slim_rows``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm.common import Sides, drop_path, group_of, slim_rows, write_once, write_sides
from tripwire.llm.suffix import removed_runs

WINDOW, GRAM = 13, 5
#: Different spans of an anchor in one task; words of a shard's automaton; word hashes kept by a task.
HOT, SHARD_WORDS, KEPT_WORDS = 1000, 20_000, 1 << 18
_ODD = [np.uint64(pow(0x9E3779B97F4A7C15 | 1, k + 1, 1 << 64)) for k in range(64)]


class WordHashes(dict):
    """64-bit hashes of words, kept while they are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def spans(words: list[bytes], hashes: WordHashes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, anchor hash): the windows first..last whose anchor this is."""
    if len(words) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    g = np.zeros(len(h) - gram + 1, np.uint64)
    for k in range(gram):
        g += h[k: len(h) - gram + 1 + k] * _ODD[k]
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    n = len(words) - window + 1
    least, at = g[:n].copy(), np.arange(n)
    for k in range(1, window - gram + 1):
        less = g[k: n + k] < least
        least[less] = g[k: n + k][less]
        at[less] = np.nonzero(less)[0] + k
    edge = np.concatenate([[0], np.nonzero(np.diff(at))[0] + 1, [n]])
    return edge[:-1], edge[1:] - 1, least[edge[:-1]].view(np.int64)


class SuffixAutomaton:
    """Suffix automaton of several word sequences; every state keeps the smallest
    id of the sequences that hold its words."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len, self.least = [-1], [0], [1 << 63]

    def _state(self, length: int, link: int, nxt: dict, least: int) -> int:
        self.next.append(nxt)
        self.len.append(length)
        self.link.append(link)
        self.least.append(least)
        return len(self.len) - 1

    def add(self, words: list[bytes], doc: int) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w, doc)

    def _split(self, p: int, q: int, w: bytes) -> int:
        clone = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]), self.least[q])
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, w: bytes, doc: int) -> int:
        q = self.next[last].get(w)
        if q is not None:  # the sequence goes along one already there
            if self.len[q] != self.len[last] + 1:
                q = self._split(last, q, w)
            self.least[q] = min(self.least[q], doc)
            return q
        cur = self._state(self.len[last] + 1, 0, {}, doc)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, w)
        return cur

    def finish(self) -> None:
        """Ids go from longer states to the suffixes they hold."""
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            u = self.link[v]
            if self.least[v] < self.least[u]:
                self.least[u] = self.least[v]

    def earlier(self, words: list[bytes], doc: int, window: int) -> list[int]:
        """Starts of the windows of ``words`` that a smaller id than ``doc`` holds."""
        out, v, matched = [], 0, 0
        for i, w in enumerate(words):
            while v and w not in self.next[v]:
                v = self.link[v]
                matched = self.len[v]
            if w in self.next[v]:
                v, matched = self.next[v][w], matched + 1
            if matched >= window:
                while self.len[self.link[v]] >= window:
                    v = self.link[v]
                matched = min(matched, self.len[v])
                if self.least[v] < doc:
                    out.append(i - window + 1)
        return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, list[bytes]]]:
    for b in batches:
        raw = b.column(2)
        for i, (row, doc) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            yield row, doc, raw[i].as_py().split()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _joined(cols: list[list[np.ndarray]], schema: pa.Schema) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(cols, schema)], schema=schema)
    for c in cols:
        c.clear()
    return out


def _schema(**kinds: pa.DataType) -> pa.Schema:
    return pa.schema(list(kinds.items()))


_NAMES = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.bool_(): "boolean", pa.string(): "string"}
ANCHORS = _schema(anchor=pa.int64(), g=pa.int32(), low=pa.int64(), high=pa.int64())
SPANS = _schema(anchor=pa.int64(), n1=pa.int64(), n2=pa.int64(), doc=pa.int64(), row=pa.int64(), first=pa.int64(), last=pa.int64())
WORDS = _schema(anchor=pa.int64(), hot=pa.bool_(), doc=pa.int64(), row=pa.int64(), first=pa.int64(), words=pa.binary())
STARTS = _schema(row=pa.int64(), first=pa.int64(), last=pa.int64())
NAMED = _schema(n1=pa.int64(), n2=pa.int64(), doc=pa.int64(), row=pa.int64(), first=pa.int64())


def _ddl(s: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_NAMES[f.type]}" for f in s)


def _shared_anchors(slim: DataFrame, window: int, gram: int) -> str:
    """Side files (g, anchor) of the anchors that two ids or more hold."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, group = WordHashes(), 0, None
        pending: list[tuple[np.ndarray, int]] = []

        def settle() -> pa.RecordBatch:
            nonlocal held
            a = np.concatenate([x for x, _ in pending])
            d = np.concatenate([np.full(len(x), doc, np.int64) for x, doc in pending])
            order = np.lexsort((d, a))
            a, d = a[order], d[order]
            new = np.concatenate([[True], a[1:] != a[:-1]])
            end = np.concatenate([np.nonzero(new)[0][1:] - 1, [len(a) - 1]])
            pending.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(np.full(int(new.sum()), group, np.int32)), pa.array(d[new]), pa.array(d[end])], schema=ANCHORS)

        for row, doc, words in _texts(batches):
            if held and (row >> 33 != group or held > 1 << 19):
                yield settle()
            group = row >> 33
            _, _, a = spans(words, hashes, window, gram)
            if doc is not None and len(a):
                a = np.unique(a)
                pending.append((a, doc))
                held += len(a)
        if held:
            yield settle()

    seen, path = write_once(slim.select("row", "id", "raw").mapInArrow(scan, _ddl(ANCHORS)), "substring-seen")
    both = seen.groupBy("anchor").agg(F.min("low").alias("l"), F.max("high").alias("h")).filter("l < h").select("anchor")
    out = write_sides(seen.select("anchor", "g").join(both, "anchor").distinct(), "substring-anchors", "anchor")
    drop_path(slim.sparkSession, path)
    return out


def _spans(slim: DataFrame, anchors: str, window: int, gram: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, hashes, held = Sides(anchors), WordHashes(), 0
        cols: list[list[np.ndarray]] = [[] for _ in SPANS]
        for row, doc, words in _texts(batches):
            wanted = sides.load(row >> 33, ["anchor"])["anchor"]
            if doc is None or not len(wanted):
                continue
            first, last, a = spans(words, hashes, window, gram)
            keep = wanted[np.minimum(np.searchsorted(wanted, a), len(wanted) - 1)] == a
            if not keep.any():
                continue
            first, last, a = first[keep], last[keep], a[keep]
            n = np.frombuffer(b"".join([xxhash.xxh3_128_digest(b" ".join(words[x:y])) for x, y in zip(first.tolist(), (last + window).tolist())]), "<i8").reshape(-1, 2)
            k = len(a)
            for c, v in zip(cols, (a, n[:, 0], n[:, 1], np.full(k, doc, np.int64), np.full(k, row, np.int64), first, last)):
                c.append(v)
            held += k
            if held > 1 << 17:
                yield _joined(cols, SPANS)
                held = 0
        yield _joined(cols, SPANS)

    return slim.select("row", "id", "raw").mapInArrow(scan, _ddl(SPANS))


def _span_words(slim: DataFrame, sides_path: str, window: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, out, held = Sides(sides_path), [], 0
        for row, doc, words in _texts(batches):
            t = sides.load(row >> 33, ["row", "first", "last", "anchor", "hot"])
            a, b = np.searchsorted(t["row"], [row, row + 1])
            for i in range(a, b):
                first, last = int(t["first"][i]), int(t["last"][i])
                out.append((int(t["anchor"][i]), bool(t["hot"][i]), doc, row, first, b" ".join(words[first: last + window])))
                held += len(out[-1][5]) + 64
            if held > 4 << 20:
                yield _batch(out, WORDS)
                out, held = [], 0
        yield _batch(out, WORDS)

    return slim.select("row", "id", "raw").mapInArrow(scan, _ddl(WORDS))


def _stream(found: DataFrame, window: int) -> DataFrame:
    """Build each shard's automaton and stream the shard's spans through it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        size, anchor = 0, None

        def match() -> list[tuple]:
            auto = SuffixAutomaton()
            for _, doc, _, _, words in shard:
                auto.add(words, doc)
            auto.finish()
            return [(row, first + x, first + x) for _, doc, row, first, words in shard for x in auto.earlier(words, doc, window)]

        for b in batches:
            out = []
            for a, doc, row, first, words in zip(*(c.to_pylist() for c in b.columns)):
                if a != anchor and size > SHARD_WORDS:
                    out += match()
                    shard, size = [], 0
                anchor = a
                shard.append((a, doc, row, first, words.split()))
                size += len(shard[-1][4])
            yield _batch(out, STARTS)
        if shard:
            yield _batch(match(), STARTS)

    cool = found.filter("NOT hot").select("anchor", "doc", "row", "first", "words")
    return cool.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _ddl(STARTS))


def _hot_windows(found: DataFrame, window: int) -> DataFrame:
    """Windows of hot anchors that a smaller id holds, by name over all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, row, first, words in zip(*(c.to_pylist() for c in b.columns)):
                w = words.split()
                for i in range(len(w) - window + 1):
                    n = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(w[i: i + window])), "<i8")
                    out.append((int(n[0]), int(n[1]), doc, row, first + i))
            yield _batch(out, NAMED)

    rows = found.filter("hot").select("doc", "row", "first", "words").mapInArrow(run, _ddl(NAMED))
    least = rows.groupBy("n1", "n2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most").select("n1", "n2", "least")
    return rows.join(least, ["n1", "n2"]).filter("doc > least").select("row", "first", F.col("first").alias("last"))


def earlier_windows(slim: DataFrame, window: int = WINDOW, gram: int = GRAM) -> str:
    """Side files (g, row, first, last): the removed windows first..last of each row."""
    anchors = _shared_anchors(slim, window, gram)
    table, t_path = write_once(_spans(slim, anchors, window, gram), "substring-spans")
    name = ["anchor", "n1", "n2"]
    # written, so that both sides of the join are plain shuffles and AQE can split a name that a third of all spans have
    names, n_path = write_once(table.groupBy(*name).agg(F.min("doc").alias("least")), "substring-names")
    # spans of a larger id than their name's least go as a whole; those of the least id wait for the automata
    marked, m_path = write_once(table.join(names, name).select("anchor", "row", "first", "last", "doc", (F.col("doc") > F.col("least")).alias("later")), "substring-marked")
    drop_path(slim.sparkSession, t_path, n_path)
    whole = marked.filter("later").select("row", "first", "last")
    own = marked.filter("NOT later")
    groups = own.groupBy("anchor").agg(F.count("*").alias("m"), F.min("doc").alias("low"), F.max("doc").alias("high")) \
        .filter("low < high").select("anchor", (F.col("m") > HOT).alias("hot"))
    open_ = own.join(groups, "anchor").select(group_of().alias("g"), "row", "first", "last", "anchor", "hot")
    open_path = write_sides(open_, "substring-open", "row", "first")
    found, f_path = write_once(_span_words(slim, open_path, window), "substring-words")
    removed = whole.union(_stream(found, window)).union(_hot_windows(found, window))
    out = write_sides(removed.withColumn("g", group_of()), "substring-starts", "row", "first")
    drop_path(slim.sparkSession, anchors, m_path, open_path, f_path)
    return out


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                    with_text: bool = False) -> DataFrame:
    """Per input row: id, n_words, n_removed, kept_sha256 (kept words joined by one
    space, UTF-8), and with ``with_text`` the kept words themselves.

    A word is removed if a window that covers it also starts in a row with a
    smaller id; all are judged on the input. Null texts have no words. Rows
    without an id are neither reference nor cut; rows of one id do not cut each
    other. Texts shorter than ``window`` words keep all. Other columns are not
    read. An empty table gives an empty result. Ids must be integers.
    """
    slim, _ = slim_rows(df, id_col, text_col, "substring-texts")
    slim = slim.withColumn("id", F.col("id").cast("long"))
    starts = earlier_windows(slim, window, gram)
    fields = list(_schema(n_words=pa.int64(), n_removed=pa.int64(), kept_sha256=pa.string(), kept=pa.binary()))[: 4 if with_text else 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides(starts)
        for b in batches:
            out = []
            for row, doc, words in _texts([b]):
                t = sides.load(row >> 33, ["row", "first", "last"])
                i, j = np.searchsorted(t["row"], [row, row + 1])
                runs = removed_runs(t["first"][i:j], t["last"][i:j], window)
                edges = [0, *runs.ravel().tolist(), len(words)]
                kept = [w for x, y in zip(edges[::2], edges[1::2]) for w in words[x:y]]
                raw = b" ".join(kept)
                out.append((doc, len(words), len(words) - len(kept), hashlib.sha256(raw).hexdigest(), raw))
            yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array([o[k + 1] for o in out], f.type) for k, f in enumerate(fields))], ["id", *(f.name for f in fields)])

    return slim.select("row", "id", "raw").mapInArrow(run, f"id long, {_ddl(pa.schema(fields))}").withColumnRenamed("id", id_col)
