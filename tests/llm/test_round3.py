"""Collocations, circulant MinHash and conversation repair against brute force."""
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_operators import brute_components, rows
from tripwire.llm import collocations


# ---- collocations -----------------------------------------------------------------

def brute_collocations(docs, min_count, longest=5, top=2000):
    count, total = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        raw = (text or "").encode().lower()
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", raw):
            ws = [w for w in re.split(rb"[\x20\x09]+", piece) if w]
            total[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    key = (lang, tuple(ws[i: i + k]))
                    count[key] = count.get(key, 0) + 1
    cand = {k: f for k, f in count.items() if f >= min_count}
    gone = {(lang, g[i: i + m]) for (lang, g), f in cand.items() for m in range(2, len(g)) for i in range(len(g) - m + 1) if f >= cand[lang, g[i: i + m]]}
    out = {}
    for (lang, g), a in cand.items():
        if len(g) > 1 and (lang, g) not in gone:
            cuts = [(1000 * a * total[lang] // (cand[lang, g[:k]] * cand[lang, g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, b" ".join(g), cand[lang, g[:k]], cand[lang, g[k:]]))
    return sorted([(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, x in out.items()
                   for i, (s, a, p, l, r) in enumerate(sorted(x)[:top])], key=repr)


COLLOCATION = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("head,tile", [(1 << 18, 1 << 10), (8, 2)])
def test_collocations(spark, head, tile):
    """All ranked; most phrases outside the head, so that hashes, bitmap and COO count them; repeated words, ties, null language and text."""
    rng = random.Random(11)
    words = ["the", "of", "New", "york", "CITY", "é", "ß", "x\x00y", "\x1c"] + [f"w{i}" for i in range(20)]
    docs = []
    for i in range(400):
        text = "".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))])[0] + rng.choice([" ", " ", " ", "\t ", ", ", ".\n", "\x0b"]) for _ in range(rng.randint(0, 60)))
        if i % 3 == 0:
            text += " one two three four five six"
        docs.append((rng.choice(["en", "de", None, "und"]), text))
    docs += [("en", None), (None, ""), ("fr", " \n.,"), ("es", "a a a a a a a a a a a a a a")] + [("en", "again and again")] * 9
    df = spark.createDataFrame([(*d, -1, -1) for d in docs], "lang string, text string, rank int, phrase int").repartition(5)
    got = rows(collocations.collocations(df, min_count=6, top=50, head=head, tile=tile), *COLLOCATION)
    want = brute_collocations(docs, 6, top=50)
    assert got == want and len(want) > 100
    assert collocations.collocations(df.limit(0)).count() == 0


def test_pair_counts_by_tile():
    rng = np.random.default_rng(3)
    a, b = (np.minimum(rng.zipf(1.3, 20000), 40) - 1 for _ in range(2))
    a[::7] = collocations.tail_id(collocations.mix(a[::7], b[::7]))
    want = Counter(zip(a.tolist(), b.tolist()))
    got = [x for part in collocations.count_pairs(a, b, 40, 8) for x in zip(*(c.tolist() for c in part))]
    assert len(got) == len(want) and {(x, y): n for x, y, n in got} == want
    assert list(collocations.count_pairs(a[:0], b[:0], 40, 8)) == []


def test_scores_beyond_64_bits(spark):
    a, l, r, n = 9 * 10 ** 14, 10 ** 15 + 7, 2 * 10 ** 15 + 1, 10 ** 18 + 9
    df = spark.createDataFrame([("en", "x y", a, [l], [r], n)], "lang string, phrase string, a long, fronts array<long>, backs array<long>, n long")
    assert collocations._scores(df, 5).first().score == 1000 * a * n // (l * r)


# ---- conversation repair ------------------------------------------------------------

def brute_repair(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, lines) of one conversation's rows in order."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {}

    def least(i, st):
        """(cost, audit, lines) from row i on in state st, inserting at most twice in a place."""
        if (i, st) not in best:
            opts = []
            for n in range(3):
                at, pre = st, []
                for _ in range(n):
                    at = follow[at]
                    pre.append(("user:" if at == "u" else "assistant:"))
                if i == len(rows):
                    if at in ("", "a"):
                        opts.append((5 * n, "I" * n, pre))
                    continue
                (role, text), f = rows[i], faults[i]
                moves = [(2, "D", at, [])]
                if f not in ("blank", "duplicate"):
                    extra = 5 * (f == "truncated")
                    if role[:1] == follow[at] or (role[:1] == "s" and at == ""):
                        moves.append((extra, "K", role[:1], [f"{role}:{text}"]))
                    moves.append((1 + extra, "R", follow[at], [f"{'user' if follow[at] == 'u' else 'assistant'}:{text}"]))
                for c, letter, to, line in moves:
                    rest = least(i + 1, to)
                    opts.append((5 * n + c + rest[0], "I" * n + letter + rest[1], pre + line + rest[2]))
            best[i, st] = min(opts, key=lambda o: o[:2])
        return best[i, st]

    for i in range(len(rows), -1, -1):
        for st in follow:
            least(i, st)
    cost, audit, lines = least(0, "")
    pairs = [(a[0][:1] + b[0][:1]) for a, b in zip(rows, rows[1:])]
    n = Counter(faults)
    return n["blank"], n["duplicate"], n["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, lines


def brute_report(data, damaged=True):
    convs = {}
    for conv, turn, role, text in data:
        rows_ = convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows_ += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rs in convs.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        turns = {t for t, _, _ in rs if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        *counts, audit, lines = brute_repair([r[1:] for r in rs])
        out.append((conv, gaps, *counts, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_conversation_sql_on_messy_rows(spark):
    import duckdb
    import pandas as pd
    from tripwire.llm.queries import ORACLES
    data = messy(8, 60, 7)
    c = duckdb.connect()
    frame = pd.DataFrame(data, columns=["conv_id", "turn", "role", "text"], dtype=object)  # noqa: F841
    c.execute("CREATE TABLE conversations AS SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, CAST(role AS VARCHAR) AS role, CAST(text AS VARCHAR) AS text FROM frame")
    res = c.execute(ORACLES["op13_conversation_repair"])
    at = [[d[0] for d in res.description].index(x) for x in REPORT]
    assert sorted([tuple(r[i] for i in at) for r in res.fetchall()], key=repr) == brute_report(data)


REPORT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
TURNS = "conv_id long, turn long, role string, text string"


def messy(seed, n, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \n", "And so on!  ", "é。", "\u2028", "x.\u0085", "x\x00.", "a\nb."] + [f"line {i}." for i in range(12)]
    out = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randint(1, longest)):
            out.append((conv, rng.choice([turn, turn, turn, turn * 2, None, 1]), rng.choice(["user", "assistant"] * 5 + ["system", "tool", "u2", "", "User", None]),
                        rng.choice(texts + [None])))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("bits", [16, 1])
def test_conversation_repair(spark, bits):
    """One segment for all, and borders of segments inside nearly all conversations."""
    data = messy(13, 60, 12) + [(77, i, "user", "Again and again.") for i in range(70)] + [(78, 5, "user", "Same.")] * 40 + \
        [(79, i, ["user", "assistant"][i % 2], f"Turn {i}." + "x" * (200000 if i == 3 else 0) + ".") for i in range(90)] + [(-2 ** 63, 3, "system", "s."), (80, 10 ** 12, "user", "Far.")]
    df = spark.createDataFrame([(*r, -1, -1) for r in data], TURNS + ", rid long, seg long").repartition(5)
    from tripwire.llm import conversations
    got = rows(conversations.report(conversations.repair(df, segment_bits=bits), df), *REPORT)
    assert got == brute_report(data, damaged=False)


def test_conversation_query(spark):
    from tripwire.llm import conversations
    from tripwire.llm.queries import QUERIES
    data = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows(QUERIES["op13_conversation_repair"](spark, "/root/testdata/sf0.01"), *REPORT) == brute_report(data)
    data = messy(5, 60, 3)
    df = spark.createDataFrame(data, TURNS)
    want = brute_report(data)
    assert rows(conversations.report(conversations.repair(conversations.damage(df)), df), *REPORT) == want and any(r[-2] == "" for r in want)
    assert conversations.report(conversations.repair(df.limit(0)), df.limit(0)).count() == 0
    assert conversations.report(conversations.repair(df.limit(0)), df.filter("conv_id = 3")).first().repaired_sha256 == hashlib.sha256().hexdigest()


def test_least_paths_by_ranks():
    """The ranks order all nodes of a random graph by their least audits."""
    from tripwire.llm.conversations import AT_END, Block, Ranks
    rng = np.random.default_rng(2)
    size = 60
    first = np.zeros(size, bool)
    first[[0, 7, 8, 30]] = True
    b = Block(first, rng.integers(0, 4, size), rng.random(size) < .2, (rng.random(size) < .3).astype(np.int64), np.ones(size, np.int64))
    r = Ranks(*b.arcs(np.broadcast_to(AT_END, (4, 4)).copy(), np.ones(4, bool)))

    def audit(v):
        out = ""
        while r.letter[v] >= 0:
            out += "DIKR"[r.letter[v]]
            v = r.pointers[0][v]
        return out

    audits = [audit(v) for v in range(b.n * 4)]
    assert [sorted(set(audits)).index(x) for x in audits] == r.rank.tolist() and [len(x) for x in audits] == r.length.tolist()
    which, at = r.paths(b.begin * 4)
    for k, v in enumerate(b.begin * 4):
        assert "".join("DIKR"[r.letter[x]] for x in at[which == k]) == audits[v]


# ---- circulant MinHash ------------------------------------------------------------

def brute_near(docs, size=5, percent=85):
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i: i + min(size, len(w))]) for i in range(len(w) - min(size, len(w)) + 1)} if w else set())
    uniq = {}
    for s in sets:
        uniq.setdefault(frozenset(s), len(uniq))
    keys = [k for k in uniq if k]
    where: dict = {}
    for i, k in enumerate(keys):
        for sh in k:
            where.setdefault(sh, []).append(i)
    both = Counter(p for v in where.values() for p in itertools.combinations(v, 2))
    parent = list(range(len(keys)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, j), n in both.items():
        if 100 * n >= percent * (len(keys[i]) + len(keys[j]) - n):
            parent[find(i)] = find(j)
    at = {k: find(i) for i, k in enumerate(keys)}
    least = {}
    for (d, _), s in zip(docs, sets):
        if s and d is not None:
            r = at[frozenset(s)]
            least[r] = min(d, least.get(r, d))
    out = []
    for (d, _), s in zip(docs, sets):
        c = least.get(at[frozenset(s)]) if s else d
        out.append((d, len(s), c, d == c))
    return sorted(out, key=repr)


NEAR = ("doc_id", "n_shingles", "component_id", "kept")


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        k = rng.randrange(len(w))
        w[k: k + rng.randint(0, 1)] = [f"e{rng.randrange(10 ** 6)}"]
    return w


def test_near_duplicates(spark, edge_docs):
    """A star and a chain of edits, sets about the limit, copies, a passage that many share; longer bands after few pairs."""
    from tripwire.llm import minhash
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    docs = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    star = [edited(rng, base, rng.randint(0, 3)) for _ in range(120)]
    chain = [[rng.choice(vocabulary) for _ in range(150)]]
    for _ in range(60):
        chain.append(edited(rng, chain[-1], 2))
    passage = [rng.choice(vocabulary) for _ in range(100)]
    shared = [passage + [rng.choice(vocabulary) for _ in range(rng.randint(12, 60))] for _ in range(80)]
    few = [[f"x{i}" for i in range(k)] for k in (1, 2, 4, 5, 6)]
    for w in star + chain + shared + few + few:
        docs.append((rng.randrange(10 ** 6), " ".join(w) if rng.random() < .5 else "\n".join(w).upper()))
    df = spark.createDataFrame([(*d, -1) for d in docs], "doc_id long, text string, node long").repartition(6)
    got = rows(minhash.near_duplicates(df, bucket_pairs=(4, 8), hubs=(1, 0, 1)), *NEAR)
    assert got == brute_near(docs)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_makes_no_rows_of_pairs(spark, monkeypatch):
    """Many sets a little under the limit: no table that is written grows with their pairs."""
    from tripwire.llm import minhash
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join(edited(rng, base, 2))) for i in range(220)]
    wrote, drop = [], minhash.drop_path
    monkeypatch.setattr(minhash, "drop_path", lambda spark, *paths: (wrote.extend(spark.read.parquet(p).count() for p in paths), drop(spark, *paths)))
    got = rows(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")), *NEAR)
    assert got == brute_near(docs)
    assert wrote and max(wrote) <= 10 * len(docs)


def test_shared_counts(monkeypatch):
    from tripwire.llm import minhash
    rng = np.random.default_rng(3)
    monkeypatch.setattr(minhash, "SLAB", 7)
    sets = [np.unique(rng.integers(0, 60, k)) for k in (0, 1, 5, 30, 30, 60, 200, 0)]
    got = minhash.shared_counts(np.concatenate(sets), np.array([len(x) for x in sets]))
    for i, j in itertools.combinations(range(len(sets)), 2):
        assert got[i, j] == got[j, i] == len(np.intersect1d(sets[i], sets[j]))
    assert not minhash.shared_counts(np.empty(0, np.int64), np.zeros(2, np.int64)).any()


def test_near_duplicate_query(spark):
    from tripwire.llm.queries import QUERIES
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = brute_near(docs)
    assert rows(QUERIES["op12_minhash"](spark, "/root/testdata/sf0.01"), *NEAR) == want and not all(r[3] for r in want)


def test_circulant_coordinates():
    """Coordinates agree as often as the sets are similar; bands of pairs at the limit share a key."""
    from tripwire.llm.minhash import BAND_ROWS, band_keys, bands_for, signature
    rng = np.random.default_rng(1)
    for j in (.3, .85):
        agree, missed = [], 0
        for _ in range(60):
            h = rng.integers(0, 2 ** 63, 400, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            k = int(round(400 * 2 * j / (1 + j)))
            a, b = h[:400], np.r_[h[:k], rng.integers(0, 2 ** 63, 400 - k, dtype=np.uint64)]
            agree.append(np.mean(signature(a, 180) == signature(b, 180)))
            for r in BAND_ROWS[:2]:
                n = bands_for(r, .85)
                missed += not (band_keys(a, r, n) == band_keys(b, r, n)).any()
        assert abs(np.mean(agree) - j) < .03 and (j < .5 or not missed)
