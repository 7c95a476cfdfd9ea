"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash of the preceding bytes says so, so documents
that share a passage share its chunks. Documents are dealt out by the least of
their chunk hashes, which brings copies and near copies to one task (a group of
copies larger than a partition is split by AQE's rebalancing), and a task
encodes each distinct chunk once while it stays in a cache of bounded bytes.

Joins: byte-level BPE works inside pre-tokens, so a cut between two pre-tokens
joins exactly. Cuts prefer such places (letter or digit, space, letter or
digit); a cut anywhere else is repaired by re-encoding from the left chunk's
last pre-tokens until the boundaries agree with the right chunk's own.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Mean distance of cuts is about SPACING words; a gap over MAX_CHUNK bytes is cut at any character.
SPACING, MAX_CHUNK = 128, 8192
#: Bytes of chunks and ids that a task keeps, and bytes of text given to the tokenizer at once.
CACHE_BYTES, ENCODE_BYTES = 48 << 20, 1 << 19
WINDOW_STEPS = 4  # the rolling hash covers 2 ** 4 bytes

_mix = np.arange(256, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
GEAR = (_mix ^ (_mix >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
_byte = np.arange(256)
ALNUM = ((_byte >= 48) & (_byte < 58)) | ((_byte >= 65) & (_byte < 91)) | ((_byte >= 97) & (_byte < 123))
_loaded: dict = {}


def tokenizer(path: str):
    """The (tokenizer, fast encoder or None) of this Python worker, without padding and truncation."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_padding()
        t.no_truncation()
        _loaded[path] = (t, fast_encoder(path))
    return _loaded[path]


def fast_encoder(path: str):
    """A faster encoder with the same ids, or None: the file's vocabulary as byte
    ranks, for a byte-level BPE without normalizer or options whose merges are in
    the order of their ids (then the rank of a merge is its id)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex") \
        and not pre.get("add_prefix_space") and not any(model.get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    added = spec.get("added_tokens", [])
    if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
        return None
    vocab = model["vocab"]
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(b <= a for a, b in zip(merged, merged[1:])):
        return None
    import public_tokenizers
    import tiktoken
    # byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"]: t["id"] for t in added}
    ranks = {bytes(byte[c] for c in w): i for w, i in vocab.items() if w not in special}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte, a hash of it and the 15 bytes before it."""
    h = GEAR[data]
    for k in range(WINDOW_STEPS):
        s = 1 << k
        nxt = h.copy()
        nxt[s:] += h[:-s] << np.uint64(s)
        h = nxt
    return h


def cut(text: str, specials: tuple[str, ...] = ()) -> list[tuple[str, bool]]:
    """(chunk, whether the cut before it joins exactly). Chunks add up to the text."""
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    if len(data) < 64:
        return [(text, True)]
    word = ALNUM[data]
    at = np.nonzero(word[:-2] & (data[1:-1] == 32) & word[2:])[0] + 1  # the space of "a b"
    h = rolling(data)
    good = at[h[at - 1] >> np.uint64(40) & np.uint64(SPACING - 1) == 0]
    cuts, safe = good, np.ones(len(good), bool)
    edges = np.concatenate([[0], good, [len(data)]])
    wide = np.nonzero(np.diff(edges) > MAX_CHUNK)[0]
    if len(wide) and not any(s in text for s in specials):
        any_at = np.nonzero(((data & 0xC0) != 0x80) & (h >> np.uint64(40) & np.uint64(MAX_CHUNK // 4 - 1) == 0))[0]
        extra = np.concatenate([any_at[(any_at > edges[i]) & (any_at < edges[i + 1])] for i in wide])
        cuts = np.concatenate([good, extra])
        safe = np.concatenate([safe, np.zeros(len(extra), bool)])
        order = np.argsort(cuts, kind="stable")
        cuts, safe = cuts[order], safe[order]
    edges = [0, *cuts.tolist(), len(raw)]
    return [(raw[a:b].decode("utf-8", "surrogatepass"), s) for a, b, s in zip(edges, edges[1:], [True, *safe.tolist()]) if b > a]


class ChunkEncoder:
    """Encodes texts through a cache of chunks."""

    def __init__(self, path: str):
        self.tok, self.fast = tokenizer(path)
        self.specials = tuple(t.content for t in self.tok.get_added_tokens_decoder().values())
        self.cache: OrderedDict[str, np.ndarray] = OrderedDict()
        self.held = self.made = self.used = 0

    def _pieces(self, text: str) -> list[tuple[int, str]]:
        """(start, pre-token). Each encodes alone as it does in the text; a longer
        part need not, for white space at its end would be split otherwise."""
        return [(a, text[a:b]) for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def _ids(self, pieces: list[tuple[int, str]]) -> np.ndarray:
        return np.concatenate([np.empty(0, np.uint32), *self._encode_all([p for _, p in pieces])])

    def _encode_all(self, texts: list[str]) -> list[np.ndarray]:
        if self.fast is not None:
            return [self.fast.encode_to_numpy(t, allowed_special="all") for t in texts]
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def chunks(self, wanted: list[str]) -> dict[str, np.ndarray]:
        """Ids of each distinct chunk; those not in the cache are encoded, once."""
        out, new, size = {}, [], 0
        self.used += len(wanted)
        for c in dict.fromkeys(wanted):
            if c in self.cache:
                self.cache.move_to_end(c)
                out[c] = self.cache[c]
            else:
                new.append(c)
                size += len(c)
            if size >= ENCODE_BYTES:
                self._encode(new, out)
                new, size = [], 0
        self._encode(new, out)
        return out

    def _encode(self, new: list[str], out: dict) -> None:
        self.made += len(new)
        for c, ids in zip(new, self._encode_all(new)):
            out[c] = self.cache[c] = ids
            self.held += 2 * len(c) + ids.nbytes + 200
        while self.held > CACHE_BYTES:
            c, ids = self.cache.popitem(last=False)
            self.held -= 2 * len(c) + ids.nbytes + 200

    def join(self, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> tuple[np.ndarray, str, np.ndarray]:
        """Repair a join at any character: (settled ids, open text, its ids).
        The open text is the rest of the right chunk that starts at a boundary
        both agree on; without one, the whole re-encoded stretch.

        What follows a chunk can change its last two pre-tokens (a run goes on, or
        an apostrophe and a letter become one), so boundaries after the start of
        the last but one never count."""
        ends = self._pieces(left)[-2:]
        tail = left[ends[0][0]:]
        kept = left_ids[: len(left_ids) - len(self._ids(ends))]
        own, y = self._pieces(right), 64
        starts = {a for a, _ in own}
        while True:
            stretch = self._pieces(tail + right[:y])
            agreed = [a - len(tail) for a, _ in stretch[:-1] if a > len(tail) and a - len(tail) in starts]
            if agreed or y >= len(right):
                break
            y *= 4
        if not agreed:
            return kept, tail + right, self._ids(stretch)
        c = agreed[0]
        settled = np.concatenate([kept, self._ids([p for p in stretch if p[0] < c + len(tail)])])
        return settled, right[c:], right_ids[len(self._ids([p for p in own if p[0] < c])):]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of whole texts, as one ``encode`` call of each would give them."""
        cuts = [cut(t, self.specials) for t in texts]
        known = self.chunks([c for t in cuts for c, _ in t])
        out = []
        for parts in cuts:
            done, open_text, open_ids = [], "", np.empty(0, np.uint32)
            for c, safe in parts:
                if safe or not open_text:
                    done.append(open_ids)
                    open_text, open_ids = c, known[c]
                else:
                    settled, open_text, open_ids = self.join(open_text, open_ids, c, known[c])
                    done.append(settled)
            out.append(np.concatenate([*done, open_ids]))
        return out


def chunk_key(text: str | None) -> int:
    """Least chunk hash of a text: equal for copies, mostly so for near copies."""
    if not text:
        return 0
    return min(xxhash.xxh64_intdigest(c.encode("utf-8", "surrogatepass")) for c, _ in cut(text)) - (1 << 63)


def bpe_round_trip(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """Per input row: id, n_tokens, ids_sha256 (ids as little-endian 32-bit
    integers), decoded_sha256 (the ids decoded, special tokens kept), and with
    ``with_ids`` the ids and the decoded text themselves.

    A null or empty text has no tokens. Rows are independent: repeated rows and
    null ids stay; other columns are not read. The tokenizer's own special tokens
    count where their strings occur in a text, as the library has it.
    """
    @F.pandas_udf("long")
    def key(texts: pd.Series) -> pd.Series:
        return pd.Series([chunk_key(t) for t in texts], dtype="int64")

    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = f"id {src.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = ChunkEncoder(tokenizer_path)
        for b in batches:
            col, at = b.column(1), 0
            while at < len(col):
                texts, size = [], 0
                while at + len(texts) < len(col) and size < 4 * ENCODE_BYTES:  # a few texts at a time, or one long one
                    texts.append(col[at + len(texts)].as_py())
                    size += len(texts[-1])
                ids = enc.encode(texts)
                back = [enc.tok.decode(x.tolist(), skip_special_tokens=False) for x in ids]
                cols = [b.column(0).slice(at, len(texts)), pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back])]
                if with_ids:
                    cols += [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(back)]
                yield pa.RecordBatch.from_arrays(cols, ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(cols)])
                at += len(texts)

    # copies meet in one task; partitions over the advisory size are split, whatever their key
    dealt = src.withColumn("key", key("text")).hint("rebalance", "key").select("id", "text")
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id_col)
