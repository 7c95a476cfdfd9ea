"""The operators on small frames, against brute force."""
import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tripwire.llm import bpe, counts, decontam, html, quality, simhash, substring, suffix, urls, warc

SF001 = "/root/testdata/sf0.001"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect() if True), key=repr)


def multi(df, key):
    out = {}
    for r in df.collect():
        d = r.asDict()
        out.setdefault(d.pop(key), []).append(tuple(d.values()))
    return {k: sorted(v, key=repr) for k, v in out.items()}


# ---- suffix and substring deduplication -----------------------------------------

def brute_suffix(docs, n):
    raws = [(d, (t or "").encode()) for d, t in docs]
    c = Counter(r[i: i + n] for _, r in raws for i in range(len(r) - n + 1))
    out = {}
    for d, r in raws:
        cov = bytearray(len(r))
        for i in range(len(r) - n + 1):
            if c[r[i: i + n]] > 1:
                cov[i: i + n] = b"\1" * n
        spans = sum(1 for i in range(len(r)) if cov[i] and (i == 0 or not cov[i - 1]))
        out.setdefault(d, []).append((len(r), sum(cov), spans, hashlib.sha256(bytes(x for x, k in zip(r, cov) if not k)).hexdigest()))
    return {k: sorted(v, key=repr) for k, v in out.items()}


def passages(seed=5):
    rng = random.Random(seed)
    base = "".join(rng.choice("ab cdé") for _ in range(3000))
    docs = []
    for i in range(60):
        a, b = rng.randint(0, 2900), rng.randint(0, 2900)
        docs.append((i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 150))) + base[a: a + rng.randint(0, 80)]
                     + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 5))) + base[b: b + 30] + base[100:130]))
    return docs + [(100, None), (101, ""), (102, "a" * 500), (103, "ab" * 100), (104, docs[3][1]), (104, docs[3][1]), (None, docs[5][1][:60])]


@pytest.mark.parametrize("hot", [1000, 3])
def test_suffix_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    docs = passages()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert multi(suffix.suffix_dedup(df, length=20), "doc_id") == brute_suffix(docs, 20)


def test_suffix_dedup_edges(spark, edge_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert multi(suffix.suffix_dedup(edge_docs), "doc_id") == brute_suffix(docs, 200)
    assert suffix.suffix_dedup(edge_docs.limit(0)).count() == 0
    kept = suffix.drop_repeats(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    got = {r.doc_id: r for r in kept.filter("doc_id IN (1, 2, 5, 7)").collect()}
    assert got[1].text == "" and got[2].text is None and got[5].text == "one" and got[5].n_chars == 3 and got[7].text == ""


def brute_substring(docs, n):
    words = [(d, (t or "").encode().split()) for d, t in docs]
    least = {}
    for d, w in words:
        for i in range(len(w) - n + 1) if d is not None else ():
            k = tuple(w[i: i + n])
            least[k] = min(least.get(k, d), d)
    out = {}
    for d, w in words:
        cov = [False] * len(w)
        for i in range(len(w) - n + 1) if d is not None else ():
            if least[tuple(w[i: i + n])] < d:
                cov[i: i + n] = [True] * n
        out.setdefault(d, []).append((len(w), sum(cov), hashlib.sha256(b" ".join(x for x, c in zip(w, cov) if not c)).hexdigest()))
    return {k: sorted(v, key=repr) for k, v in out.items()}


@pytest.mark.parametrize("hot, shard", [(1000, 20000), (2, 50)])
def test_substring_dedup(spark, monkeypatch, hot, shard):
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "SHARD_WORDS", shard)
    rng = random.Random(5)
    base = [rng.choice("abcdefg") for _ in range(3000)]
    docs = []
    for _ in range(80):
        b = rng.randint(0, 500)
        docs.append((rng.randint(0, 90), " ".join([rng.choice("abcdefghij") for _ in range(rng.randint(0, 30))] + base[b: b + rng.randint(0, 80)]
                                                  + ["q"] * rng.randint(0, 3) + base[100: 100 + rng.randint(10, 40)])))
    docs += [(100, None), (101, ""), (102, "a " * 500), (103, "a b " * 100), (104, docs[3][1]), (104, docs[3][1]), (None, docs[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert multi(substring.substring_dedup(df), "doc_id") == brute_substring(docs, 13)


def test_substring_dedup_edges(spark, edge_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert multi(substring.substring_dedup(edge_docs), "doc_id") == brute_substring(docs, 13)
    assert substring.substring_dedup(edge_docs.limit(0)).count() == 0


# ---- quality ----------------------------------------------------------------------

def brute_features(t):
    w = (t or "").encode().split()
    w = [x.decode() for x in w]
    c = Counter(zip(w, w[1:], w[2:]))
    cov = {j for i in range(len(w) - 2) if c[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (t or "").split("\n") if x.encode().split()]
    return (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), len(lines) - len(set(lines)), len(cov), len(w) < 50 or 100 * len(cov) > 50 * len(w))


def test_quality_features(spark, edge_docs):
    extra = spark.createDataFrame([(20, "a b c\na b c\n d \n\n a b c x"), (21, "x y x y x y x"), (22, "## a|b ** <c>\n## a|b ** <c>")], "doc_id long, text string")
    docs = edge_docs.unionByName(extra, allowMissingColumns=True)
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_rules(docs, labels)
    want = {}
    for r in docs.collect():
        f = brute_features(r.text)
        want.setdefault(r.doc_id, []).append((*f, not f[5]))
    assert multi(got.drop("failed_rules"), "doc_id") == {k: sorted(v, key=repr) for k, v in want.items()}
    assert quality.quality_rules(docs.limit(0), labels.limit(0)).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_binomial_tail(spark):
    cases = [(n, k, p) for n in (1, 5, 50, 900) for k in (0, 1, 4, 30) if k <= n for p in (0.01, 0.2)]
    for p in (0.01, 0.2):
        df = spark.createDataFrame([(n, k) for n, k, q in cases if q == p], "n long, k long")
        for r in df.withColumn("t", quality.binomial_tail(F.col("n"), F.col("k"), p)).collect():
            want = sum(math.comb(r.n, i) * p**i * (1 - p) ** (r.n - i) for i in range(r.k + 1))
            assert r.t == pytest.approx(want, rel=1e-9)


def test_thresholds_are_certified_and_useful(spark):
    rng = random.Random(0)
    feats, labels = [], []
    for i in range(6000):
        lang, good = ("en", rng.random() < 0.8) if i < 5900 else ("xx", True)  # xx: too few labels for any bound
        sym = (100 if rng.random() < 0.002 else 3 * rng.random()) if good else 60 + 100 * rng.random()
        feats.append((i, lang, 100, 500, int(sym), 0, 0, 10, 10, False))
        labels.append((i, int(good)))
    df = spark.createDataFrame(feats, "doc_id long, lang string, " + ", ".join(
        f"__q_{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")) + ", __q_base_failed boolean")
    lab = spark.createDataFrame(labels + labels[:50], "doc_id long, quality int")
    got = {r.stratum: r for r in quality.thresholds(df, "doc_id", "lang", lab).collect()}
    best, a = got["en"], quality.ALPHA
    assert quality.cutoff_at(quality.RULES[0][2], best.setting, quality.N_SETTINGS) == 0.5
    n = best.n_good
    assert best.n_caught == best.n_bad == sum(1 - g for _, g in labels[:5900])
    tail = sum(math.comb(n, i) * a**i * (1 - a) ** (n - i) for i in range(best.n_false + 1))
    assert best.tail == pytest.approx(tail, rel=1e-6) and tail <= quality.DELTA / 2
    assert got["xx"].setting is None


@pytest.mark.parametrize("n_good, n_false, certified", [(58, 0, False), (59, 0, True), (92, 1, False), (93, 1, True)])
def test_settings_need_their_labels(spark, n_good, n_false, certified):
    """One stratum: the first counts with P(Bin(n, 0.05) <= k) <= 0.05 are 59 for none and 93 for one false rejection."""
    sym = [500] * n_false + [0] * (n_good - n_false) + [500] * 20  # 20 labelled bad
    df = spark.createDataFrame([(i, "en", 100, 500, x, 0, 0, 10, 10) for i, x in enumerate(sym)], "doc_id long, lang string, " + ", ".join(
        f"__q_{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")))
    lab = spark.createDataFrame([(i, int(i < n_good)) for i in range(len(sym))], "doc_id long, quality int")
    r = quality.thresholds(df, "doc_id", "lang", lab).collect()[0]
    assert (r.setting, r.n_caught) == ((1, 20) if certified else (None, None))


def test_cutoffs_of_settings_only_fall():
    for _, _, grid in quality.RULES:
        cut = [quality.cutoff_at(grid, j, quality.N_SETTINGS) for j in range(1, quality.N_SETTINGS + 1)]
        assert cut[0] == grid[0] and cut[-1] == grid[-1] and sorted(cut, reverse=True) == cut and set(cut) == set(grid)


# ---- HTML, URLs -------------------------------------------------------------------

def test_extract_edges(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (1, "u", None, 1), (None, None, "", 2), (2, "v", "<article><p>Some text of an article here.", 3)],
                                  "page_id long, url string, html string, text int")
    assert rows(html.extract(pages), "page_id", "url", "text", "n_chars") == sorted(
        [(1, "u", "", 0), (1, "u", "", 0), (None, None, "", 0), (2, "v", "Some text of an article here.", 29)], key=repr)
    assert html.extract(pages.limit(0)).count() == 0


def test_url_filter_edges(spark):
    rules = [("block", "bad.com", "/"), ("allow", "ok.bad.com", "/x/"), ("block", "", "")]
    pages = spark.createDataFrame([(1, "http://BAD.com/a?b#c", "r"), (2, "https://ok.bad.com/x/y", "r"), (3, None, "r"), (None, "no scheme", "r"), (5, "ftp://a.org", "r"),
                                   (5, "ftp://a.org", "r"), (6, "http://É.Bad.com/é", "r"), (7, "http://bad.com?x=/", "r"), (8, "x://" + "a." * 5000 + "bad.com/" + "p/" * 5000, "r")],
                                  "page_id long, url string, rule string")
    got = rows(urls.url_filter(pages, rules, default="allow"), "page_id", "host", "path", "rule", "verdict")
    long = ("a." * 5000 + "bad.com", "/" + "p/" * 5000)
    assert got == sorted([(1, "bad.com", "/a", "bad.com/", "block"), (2, "ok.bad.com", "/x/y", "ok.bad.com/x/", "allow"), (3, "", "", "", "block"), (None, "", "", "", "block"),
                          (5, "a.org", "", None, "allow"), (5, "a.org", "", None, "allow"), (6, "É.bad.com", "/é", "bad.com/", "block"), (7, "bad.com", "", None, "allow"),
                          (8, *long, "bad.com/", "block")], key=repr)
    assert urls.url_filter(pages.limit(0), rules).count() == 0 and urls.url_filter(pages, []).filter("verdict = 'allow'").count() == 9
    with pytest.raises(ValueError):
        urls.url_filter(pages, [("block", "x" * (urls.MAX_RULE_CHARS + 1), "/")])


# ---- decontamination --------------------------------------------------------------

def test_contamination(spark, edge_docs, monkeypatch):
    item = "lazy dog. the quick brown fox jumps over the lazy dog"
    items = spark.createDataFrame([(1, item, 0), (2, item, 0), (3, None, 0), (4, "", 0), (None, "one", 0), (5, "nowhere to be found in any of these", 0)],
                                  "item_id long, text string, doc_id int")
    want = sorted([(d, i, 0) for d in (1, 1, None) for i in (1, 2)], key=repr)
    assert rows(decontam.contamination(edge_docs, items), "doc_id", "item_id", "distance") == want
    monkeypatch.setattr(decontam, "MAX_BROADCAST", 40)  # several passes
    assert rows(decontam.contamination(edge_docs, items), "doc_id", "item_id", "distance") == want
    kept = decontam.drop_contaminated(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 3
    assert decontam.contamination(edge_docs.limit(0), items).count() == 0
    assert decontam.contamination(edge_docs, items.limit(0)).count() == 0
    assert decontam.drop_contaminated(edge_docs, items.limit(0)).count() == edge_docs.count()


# ---- BPE, counts ------------------------------------------------------------------

def test_bpe_edges(spark, edge_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = bpe.tokenizer(path)[0]
    want = {}
    for r in edge_docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        want.setdefault(r.doc_id, []).append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                              hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert multi(bpe.bpe_round_trip(edge_docs, path), "doc_id") == {k: sorted(v, key=repr) for k, v in want.items()}
    full = bpe.bpe_round_trip(edge_docs.filter("doc_id = 7"), path, with_ids=True).first()
    assert full.decoded == "é€🙂 " * 100 and len(full.ids) == full.n_tokens
    assert bpe.bpe_round_trip(edge_docs.limit(0), path).count() == 0


def test_rollup(spark, tmp_path):
    put = lambda *r: spark.createDataFrame([(*x, "put") for x in r], "doc_id long, version string, source string, lang string, tokens long, op string")
    r = counts.Rollup(spark, str(tmp_path / "roll"))
    totals = lambda: rows(r.totals(), "source", "lang", "version", "n_docs", "n_tokens")
    assert totals() == []
    first = put((1, "v", "a", "en", 10), (2, "v", "a", "en", 5), (3, "v", None, None, None), (1, "w", "a", "en", 7), (None, "v", "a", "en", 99), (2, None, "a", "en", 9), (1, "v", "a", "en", 10))
    assert r.commit(1, first) and not r.commit(1, first)
    assert totals() == sorted([("a", "en", "v", 2, 15), (None, None, "v", 1, 0), ("a", "en", "w", 1, 7)], key=repr)
    # revised counts, another source, a delete, a delete of what is not there, and a batch with put and delete
    gone = spark.createDataFrame([(2, "v", None, None, None, "delete"), (9, "v", None, None, None, "delete"), (4, "v", "a", "en", 3, "put"), (4, "v", "a", "en", 3, "delete")], first.schema)
    assert r.commit(2, put((1, "v", "b", "en", 4)).union(gone))
    assert totals() == sorted([("b", "en", "v", 1, 4), (None, None, "v", 1, 0), ("a", "en", "w", 1, 7)], key=repr)
    assert r.commit(3, put((2, "v", "a", "en", 6))) and r.commit(4, first.limit(0)) and r.batches() == [1, 2, 3, 4]
    assert totals() == sorted([("a", "en", "v", 1, 6), ("b", "en", "v", 1, 4), (None, None, "v", 1, 0), ("a", "en", "w", 1, 7)], key=repr)
    assert counts.Rollup(spark, str(tmp_path / "roll")).totals().count() == 4
    # ids must rise: totals of later batches were counted without an earlier one
    late = counts.Rollup(spark, str(tmp_path / "late"))
    assert late.commit(3, put((1, "v", "a", "en", 10)))
    with pytest.raises(ValueError):
        late.commit(2, put((1, "v", "a", "en", 7)))
    assert late.commit(4, put((1, "v", "a", "en", 5)).withColumn("batch", F.lit(-1))) and not late.commit(4, put((1, "v", "a", "en", 8)))
    assert [(r.n_docs, r.n_tokens) for r in late.totals().collect()] == [(1, 5)]
    # a batch that died before its commit is not read
    (tmp_path / "roll/unfinished/9-x/delta").mkdir(parents=True)
    assert r.batches() == [1, 2, 3, 4]


# ---- WARC -------------------------------------------------------------------------

def test_warc(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    big = "<p>é</p>" * 300
    data = [(1, "http://b.com/x", big), (2, "http://a.com/y\tz", big), (3, None, big), (4, "http://a.com/", "small"), (5, "http://a.com/", "small"), (None, "http://c.d.com/", big),
            (6, "not a url", None), (7, "http://a.com/", ""), (8, "http://a.com/é\r\n: x", "q" * 1000), (8, "http://a.com/é\r\n: x", "q" * 1000), (9, "http://z.org/" + "p" * 5000, "w" * 2_000_000)]
    df = spark.createDataFrame([(*x, 0) for x in data], "page_id long, url string, html string, digest int").repartition(4)
    want = []
    for i, _, h in data:
        raw = (h or "").encode()
        keep = max((j for j, _, g in data if j is not None and g == h), default=None) if len(raw) >= 1000 and i is not None else None
        own = keep is None or keep == i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if own else "revisit", None if own else keep))
    assert rows(warc.warc_round_trip(df), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    archive = warc.write_archive(df)
    key = df.filter("page_id = 4").select(warc.url_key("url").alias("key"), F.lit(None).cast("long").alias("id"))
    found = warc.lookup(archive, key.union(spark.createDataFrame([("com,zz)/", None)], "key string, id long")))
    assert sorted(r.id for r in found.collect()) == [4, 5, 7]
    assert sorted(bytes(r.payload) for r in warc.read_records(found).collect()) == [b"", b"small", b"small"]
    assert warc.warc_round_trip(df.limit(0)).count() == 0


# ---- SimHash ----------------------------------------------------------------------

def brute_components(fps, distance=2):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_and_components(spark, distance):
    rng = random.Random(distance)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for c in list(fps)[:6]:
        for _ in range(60):
            fps.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    fps = sorted(x - (1 << 63) for x in fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {tuple(r) for r in simhash.links(df, distance).collect()}
    assert got == {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
    from tripwire.llm.common import components
    roots = {r.node: r.root for r in components(simhash.links(df, distance))[0].collect()}
    group = brute_components([x & (1 << 64) - 1 for x in fps], distance)
    least = {}
    for x, g in zip(fps, group):
        least.setdefault(g, x)
    assert {x: roots.get(x, x) for x in fps} == {x: least[g] for x, g in zip(fps, group)}


def test_simhash_components(spark, edge_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    fps = [simhash.fingerprint(t) for _, t in docs]
    group = brute_components(fps)
    least = {g: min((d for (d, _), h in zip(docs, group) if h == g and d is not None), default=None) for g in group}
    want = sorted([(d, f"{f:016x}", least[g]) for (d, _), f, g in zip(docs, fps, group)], key=repr)
    assert rows(simhash.simhash_components(edge_docs), "doc_id", "fingerprint", "component_id") == want
    assert simhash.simhash_components(edge_docs.limit(0)).count() == 0
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(least.values(), key=repr)
