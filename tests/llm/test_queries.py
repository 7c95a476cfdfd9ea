"""Registered queries against their SQL, and the pipeline against a brute-force version."""
import hashlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.test_operators import brute_components, multi
from tripwire.llm import bpe, decontam, simhash, suffix
from tripwire.llm.queries import BPE_JSON, ORACLES, QUERIES

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF001)
    cols = sorted(df.columns)
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted([tuple(dict(zip(names, r))[c] for c in cols) for r in res.fetchall()], key=repr)
    assert sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr) == want


def test_quality_query_where_rules_have_cutoffs(spark):
    """At sf0.1, the only given size with enough labels for a cutoff."""
    c = duckdb.connect()
    for t in ("documents", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    want = dict(c.execute(f"SELECT doc_id, kept OR base_failed FROM ({ORACLES['op2_quality_rules']})").fetchall())
    got = {r.doc_id: r.kept or r.base_failed for r in QUERIES["op2_quality_rules"](spark, SF01).collect()}
    assert got == want and not all(want.values())


def test_decontamination_query(spark, con):
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    got = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op4_decontaminate"](spark, SF001).collect()}
    want = {}
    for d, t in con.execute("SELECT doc_id, text FROM documents").fetchall():
        for i, x in items:
            x = decontam.normal(x)
            dist, _ = decontam.edit_search(x, decontam.normal(t))
            if dist <= int(len(x) * decontam.RATE):
                want[d, i] = dist
    assert got == want and want


def test_token_count_query(spark, con):
    tok = bpe.tokenizer(BPE_JSON)[0]
    labels = {d: (q, t) for d, q, t in con.execute("SELECT doc_id, quality, toxic FROM labels").fetchall()}
    want = {}
    for d, text, source, lang in con.execute("SELECT doc_id, text, source, lang FROM documents").fetchall():
        q, t = labels.get(d, (1, 0))
        if t:
            continue
        if not q:
            text = "\n".join(dict.fromkeys(text.split("\n")))
        for v, n in (("byte_bpe_50k", len(tok.encode(text, add_special_tokens=False).ids)), ("words", len(text.encode().split()))):
            x = want.setdefault((source, lang, v), [0, 0])
            x[0] += 1
            x[1] += n
    assert {(r.source, r.lang, r.version): [r.n_docs, r.n_tokens] for r in QUERIES["op6_token_counts"](spark, SF001).collect()} == want


def test_pipeline(spark, con):
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op2_quality_rules']}) WHERE kept").fetchall()}
    docs = [(d, t) for d, t in con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall() if d in kept]
    group = brute_components([simhash.fingerprint(t) for _, t in docs])
    first = {}
    for (d, _), g in zip(docs, group):
        first.setdefault(g, d)
    docs = [(d, t) for (d, t), g in zip(docs, group) if first[g] == d]
    count: dict[bytes, int] = {}
    for _, t in docs:
        raw = t.encode()
        for i in range(len(raw) - 199):
            count[raw[i: i + 200]] = count.get(raw[i: i + 200], 0) + 1
    items = [decontam.normal(x) for _, x in con.execute("SELECT item_id, text FROM benchmark").fetchall()]
    tok, want = bpe.tokenizer(BPE_JSON)[0], {}
    for d, t in docs:
        raw = t.encode()
        at = np.array([i for i in range(len(raw) - 199) if count[raw[i: i + 200]] > 1], np.int64)
        t = suffix.kept_bytes(raw, suffix.whole_characters(raw, suffix.removed_runs(at, at, 200))).decode()
        if any(decontam.edit_search(x, decontam.normal(t))[0] <= int(len(x) * decontam.RATE) for x in items):
            continue
        ids = tok.encode(t, add_special_tokens=False).ids
        want[d] = [(len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())]
    assert multi(corpus_pipeline.run(spark, SF001), "doc_id") == want and len(want) < len(docs)
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "repeated_passages", "benchmark_leaks", "tokens"]


def test_rows_of_a_run_outlive_the_next_run(spark):
    first, second = (corpus_pipeline.run(spark, SF001) for _ in range(2))
    assert multi(first, "doc_id") == multi(second, "doc_id")


def test_stages_hand_python_small_batches(spark):
    @corpus_pipeline.stage
    def probe(spark, docs, sf_dir):
        return docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")

    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    try:
        for own, most in (("10000", 1000), ("0", 1000), ("300", 300)):  # 0: no bound; a smaller one of the session's own stays
            spark.conf.set(conf, own)
            got = [r.n for r in probe(spark, spark.range(0, 2500, 1, 1), SF001).collect()]
            assert sum(got) == 2500 and max(got) == most
    finally:
        spark.conf.set(conf, before)
