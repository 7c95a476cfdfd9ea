"""Benchmark decontamination: documents that hold a benchmark item, up to a rate
of edits.

Texts and items are compared as UTF-8 bytes with A-Z lower-cased and each white
space byte a blank (so offsets stay those of the text). For an item of n bytes,
e = rate * n edits are allowed.

1. Windows. Cut the item into e + 1 pieces: e edits leave one of them as it is.
   So every match has an item-sized window placed by a piece that occurs in the
   text; pieces are found by their first bytes in a bit table and then whole.
   No match within e edits is lost here.
2. CGK embedding. Window and item go through the same random walk (read a byte,
   move on or stay by a random bit of step and byte), which maps few edits to few
   differing coordinates.
3. Bit-sampling LSH. A signature is k sampled coordinates; a window is a
   candidate if any of the repeated signatures of any of the walks meets its
   item's. The number of signatures is computed from the target recall and the
   agreement measured on seeded edits of every item; the windows of an item that
   this number does not bring to the recall are all candidates.
4. Candidates are verified by exact edit distance (bit-parallel), best placement
   within the allowed edits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits per byte of the item; wanted share of true matches that become candidates.
RATE, RECALL = 0.08, 0.999
#: Coordinates of a signature, random walks; seeded edits of each item for calibration, and
#: the quantile of the items that sets the number of signatures (the items under it need none).
SAMPLED, WALKS, CALIBRATION_RUNS, QUANTILE = 4, 6, 16, 0.01
#: Bytes of items broadcast at once (larger sets go in several passes), and of text searched at once.
MAX_BROADCAST, SLICE = 32 << 20, 1 << 20
#: Characters of texts joined for one search, and bytes of walks or sampled coordinates held at once.
JOINED, WORK = 4 << 20, 8 << 20
BITS = 22
NORMAL = bytes(32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MUL = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL)


def edit_search(pattern: bytes, text: bytes) -> tuple[int, int]:
    """(least edit distance of pattern to a substring of text, its end)."""
    n = len(pattern)
    full, top = (1 << n) - 1, 1 << (n - 1)
    at: dict[int, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    plus, minus, score, best, end = full, 0, n, n, 0
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        x = ((eq & plus) + plus ^ plus) | eq | minus
        up = minus | ~(x | plus) & full
        down = plus & x
        score += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        v = eq | minus
        plus = down | ~(v | up) & full
        minus = up & v
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """The tables of a set of items (id, text); built once and broadcast."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, recall: float = RECALL, seed: int = 1):
        norm = {}
        for i, t in sorted(items, key=lambda x: x[0]):
            norm.setdefault(normal(t), []).append(i)
        norm.pop(b"", None)
        self.texts, self.ids = list(norm), list(norm.values())
        self.edits = [int(len(t) * rate) for t in self.texts]
        self.pieces: dict[int, dict[bytes, list[tuple[int, int]]]] = {}  # by gram length, by piece: (item, offset)
        for k, (t, e) in enumerate(zip(self.texts, self.edits)):
            cuts = self._cuts(t, e)
            gram = min(8, min(b - a for a, b in zip(cuts, cuts[1:])))
            for a, b in zip(cuts, cuts[1:]):
                self.pieces.setdefault(gram, {}).setdefault(t[a:b], []).append((k, a))
        self.lengths = {g: sorted({len(p) for p in d}) for g, d in self.pieces.items()}
        self.tables = {}
        for g, d in self.pieces.items():
            table = np.zeros(1 << BITS, bool)
            grams = np.array([int.from_bytes(p[:g], "little") for p in d], np.uint64)
            table[(grams * _MUL) >> np.uint64(64 - BITS)] = True
            self.tables[g] = table
        rng = np.random.default_rng(seed)
        n = np.array([len(t) for t in self.texts] or [1])
        self.steps = 2 * int(n.max())  # a walk reads half a byte a step
        self.walks = [rng.integers(0, 2, (self.steps, 256), dtype=np.uint8) for _ in range(WALKS)]
        self.signatures, self.always = self._calibrate(recall, np.random.default_rng(seed + 1))
        share = [rng.random((self.signatures, SAMPLED)) for _ in range(WALKS)]
        # sampled coordinates of each item: (walk)(item, signature, coordinate)
        self.coords = [(s[None] * (2 * n - 1)[:, None, None]).astype(np.int32) for s in share]
        if self.texts:
            buf = np.frombuffer(b"".join(self.texts) + b"\0", np.uint8)
            starts = np.concatenate([[0], np.cumsum(n)[:-1]])
            each = np.arange(len(n))
            self.marks = [self._sample(self._walk(w, buf, starts, n), each, c) for w, c in zip(self.walks, self.coords)]

    @staticmethod
    def _cuts(t: bytes, e: int) -> list[int]:
        return [len(t) * i // (e + 1) for i in range(e + 2)]

    def _walk(self, walk: np.ndarray, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, steps: int | None = None) -> np.ndarray:
        """CGK embedding of windows of ``buf``: (steps, windows) bytes, 0 after the end."""
        steps = steps or self.steps
        out = np.empty((steps, len(starts)), np.uint8)
        i = np.zeros(len(starts), np.int64)
        for j in range(steps):
            c = buf[starts + np.minimum(i, lengths - 1)]
            c[i >= lengths] = 0
            out[j] = c
            i += walk[j][c]
        return out

    @staticmethod
    def _sample(embedded: np.ndarray, which: np.ndarray, coords: np.ndarray) -> np.ndarray:
        """(windows, signatures, coordinates) bytes at the coordinates of each window's item."""
        return embedded[coords[which], np.arange(len(which))[:, None, None]]

    def _edited(self, k: int, rng: np.random.Generator) -> bytes:
        """The window that a match of item ``k`` has at the full number of edits (a third
        each: insert, delete, replace) with one in each piece but one: only that piece
        places a window, at its place minus its offset, whatever the edits shifted."""
        t, e = self.texts[k], self.edits[k]
        cuts, whole = self._cuts(t, e), int(rng.integers(e + 1))
        parts = [t[a:b] for a, b in zip(cuts, cuts[1:])]
        for i, (at, kind, c) in enumerate(zip(rng.random(e + 1).tolist(), rng.integers(3, size=e + 1).tolist(), rng.integers(97, 123, size=e + 1).tolist())):
            if i != whole:
                p, x = int(at * len(parts[i])), parts[i]
                parts[i] = x[:p] + (b"" if kind == 1 else bytes([c])) + x[p + (kind != 0):]
        before, after = rng.integers(97, 123, size=(2, e), dtype=np.uint8)
        begin = e + sum(map(len, parts[:whole])) - cuts[whole]
        return (before.tobytes() + b"".join(parts) + after.tobytes())[begin: begin + len(t)]

    def _calibrate(self, recall: float, rng: np.random.Generator) -> tuple[int, np.ndarray]:
        """Signatures per walk for the recall, from the least agreement of each item with
        its seeded edits, and the items that need more: their windows are all verified."""
        always = np.zeros(len(self.texts), bool)
        items = np.array(sorted((k for k, e in enumerate(self.edits) if e), key=lambda k: len(self.texts[k])), np.int64)
        if not len(items):
            return 1, always
        # chance that a round (one signature from each walk) meets
        meets, at = np.ones(len(items)), 0
        while at < len(items):  # items of about one length, 64 MB of walks at once
            n = np.array([len(self.texts[k]) for k in items[at:]])
            m = max(1, int(np.searchsorted(4 * n * np.arange(1, len(n) + 1), 64 << 20, "right")))
            n = n[:m]
            for _ in range(CALIBRATION_RUNS):
                buf = np.frombuffer(b"".join(x for k in items[at: at + m] for x in (self.texts[k], self._edited(k, rng))) + b"\0", np.uint8)
                lengths, none = np.repeat(n, 2), np.ones(m)
                starts = np.cumsum(lengths) - lengths
                for w in self.walks:
                    x = self._walk(w, buf, starts, lengths, 2 * int(n[-1]))
                    same = (x[:, ::2] == x[:, 1::2]) & (np.arange(len(x))[:, None] < 2 * n)
                    none *= 1 - (same.sum(0) / (2 * n)) ** SAMPLED
                meets[at: at + m] = np.minimum(meets[at: at + m], 1 - none)
            at += m
        p = max(1e-3, float(np.quantile(meets, QUANTILE)))
        signatures = max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(p, 0.999))))
        always[items] = (1 - meets) ** signatures > 1 - recall
        return signatures, always

    def windows(self, buf: bytes) -> list[tuple[int, int]]:
        """(item, start) of the windows that a whole piece places in ``buf``
        (which ends with 8 zero bytes)."""
        found = set()
        for g, table in self.tables.items():
            pieces, lengths, keep = self.pieces[g], self.lengths[g], np.uint64((1 << 8 * g) - 1)
            for at in range(0, len(buf) - 8, SLICE):
                view = np.ndarray((min(SLICE, len(buf) - 8 - at),), "<u8", buf, at, (1,))
                h = (view if g == 8 else view & keep) * _MUL
                h >>= np.uint64(64 - BITS)
                for p in (np.nonzero(table[h])[0] + at).tolist():
                    for n in lengths:
                        for k, o in pieces.get(buf[p: p + n], ()):
                            found.add((k, p - o))
        return sorted(found)

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(index of text, item id, distance, start, end) of the best placement of
        each item in each text, ordered; offsets are bytes of the text in UTF-8.
        Texts are joined and searched in runs of about JOINED characters."""
        out, begin, held = [], 0, 0
        for i, t in enumerate(texts):
            held += len(t or "")
            if held >= JOINED or i == len(texts) - 1:
                out += [(begin + d, *v) for d, *v in self._find(texts[begin: i + 1])]
                begin, held = i + 1, 0
        return out

    def _find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        raw = [normal(t) for t in texts]
        starts = np.cumsum([0, *(len(r) + 1 for r in raw)])
        buf = b"\0".join(raw) + b"\0" * 9
        placed = self.windows(buf)
        if not placed:
            return []
        item = np.array([k for k, _ in placed])
        start = np.array([s for _, s in placed], np.int64)
        length = np.array([len(t) for t in self.texts])[item]
        allowed = np.array(self.edits)[item]
        # the text in which the window's middle lies; windows that stick out are cut to it
        doc = np.clip(np.searchsorted(starts, np.maximum(start + length // 2, 0), "right") - 1, 0, len(raw) - 1)
        lo, hi = starts[doc], starts[doc + 1] - 1
        begin, stop = np.maximum(start, lo), np.minimum(start + length, hi)
        fits = (begin - start <= allowed) & (start + length - stop <= allowed) & (stop > begin)
        item, doc, begin, stop, lo, hi = (x[fits] for x in (item, doc, begin, stop, lo, hi))
        if not len(item):
            return []
        data = np.frombuffer(buf, np.uint8)
        candidate = self.always[item]
        walked, met = (max(1, min(8192, WORK // n)) for n in (self.steps, 8 * SAMPLED * self.signatures))
        for at in range(0, len(item), walked):
            part = slice(at, at + walked)
            for walk, coords, marks in zip(self.walks, self.coords, self.marks):
                embedded = self._walk(walk, data, begin[part], stop[part] - begin[part])
                for a in range(0, embedded.shape[1], met):
                    which = item[part][a: a + met]
                    got = self._sample(embedded[:, a: a + met], which, coords)
                    candidate[at + a: at + a + len(which)] |= (got == marks[which]).all(axis=2).any(axis=1)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for k, d, b, s, low, high in zip(*(x[candidate].tolist() for x in (item, doc, begin, stop, lo, hi))):
            t, e = self.texts[k], self.edits[k]
            old = best.get((d, k))
            if old and (old[0] == 0 or abs(old[1] - (b - low)) <= e):
                continue
            b, s = max(low, b - e), min(high, s + e)
            dist, end = edit_search(t, buf[b:s])
            if dist <= e:
                _, back = edit_search(t[::-1], buf[b: b + end][::-1]) if dist else (0, len(t))
                got = (dist, b - low + end - back, b - low + end)
                best[d, k] = min(best.get((d, k), got), got)
        return sorted((d, i, *v) for (d, k), v in best.items() for i in self.ids[k])


def _blocks(items: DataFrame, item_id: str, item_text: str) -> Iterator[list[tuple[int, str]]]:
    """The items in lists of at most about MAX_BROADCAST bytes, by hash of the id."""
    rows = items.select(F.col(item_id).alias("i"), F.col(item_text).cast("string").alias("t")).filter("i IS NOT NULL AND t IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-size // MAX_BROADCAST) or 1
    for k in range(n):
        yield [tuple(r) for r in rows.filter(F.pmod(F.xxhash64("i"), F.lit(n)) == k).collect()]


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", rate: float = RATE, recall: float = RECALL) -> DataFrame:
    """(id, item_id, distance, start, end): a row for each document row and item
    it holds, with the best placement (bytes of the text in UTF-8).

    Null and empty texts hold nothing, null and empty items and items without an
    id are never held; equal items are each reported. Repeated document rows are
    reported each. Documents never leave their partition."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {src.schema['id'].dataType.simpleString()}, item_id {items.schema[item_id].dataType.simpleString()}, distance int, start long, `end` long"
    out = None
    for block in _blocks(items, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Matcher(block, rate, recall))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for b in batches:
                got = shared.value.find(b["text"].tolist())
                yield pd.DataFrame({"id": b["id"].iloc[[g[0] for g in got]].values, **{
                    c: [g[i + 1] for g in got] for i, c in enumerate(("item_id", "distance", "start", "end"))}})

        part = src.mapInPandas(run, schema)
        out = part if out is None else out.union(part)
    return out.withColumnRenamed("id", id_col)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                      rate: float = RATE, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` whose text holds no item; all columns stay."""
    out = docs
    for block in _blocks(items, item_id, item_text):
        out = out.filter(~_held(docs.sparkSession.sparkContext.broadcast(Matcher(block, rate, recall)))(F.col(text_col).cast("string")))
    return out


def _held(shared):
    """A column function: whether a text holds any item of the broadcast matcher."""
    @F.pandas_udf("boolean")
    def held(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            hit = {g[0] for g in shared.value.find(s.tolist())}
            yield pd.Series([i in hit for i in range(len(s))], dtype=bool)

    return held
