"""The queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.llm import bpe, collocations, conversations, counts, decontam, html, minhash, quality, simhash, substring, suffix, urls, warc
from tripwire.llm.common import SPACE_RE, read_table, scratch_path, write_once

import public_tokenizers

BPE_JSON, BPE_RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.suffix_dedup(read_table(spark, sf_dir, "documents"), length=200)


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("failed_rules")


#: The rules of the query (verdict, host, path).
URL_RULES: list[urls.Rule] = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_filter(read_table(spark, sf_dir, "pages"), URL_RULES)


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, distance=2)


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(read_table(spark, sf_dir, "pages"))


ORACLES["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS keeper FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to FROM m
"""

ORACLES["op9_url_filter"] = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


@query
def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages"))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(read_table(spark, sf_dir, "documents"), BPE_JSON)


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches over all documents: all are put; those labelled
    of low quality are revised to their counts without repeated lines; those
    labelled toxic are deleted. The second batch is committed twice, as after a
    lost driver; it counts once. Versions: byte-level BPE tokens, and words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lean = F.array_join(F.array_distinct(F.split(text, "\n")), "\n")
    words = lambda t: F.size(F.array_remove(F.split(t, SPACE_RE), ""))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", text.alias("text"), F.when(lean != text, lean).alias("lean"))
    docs, _ = write_once(docs.select(
        "doc_id", "source", "lang", counts.tokens_column("text", BPE_RANKS).alias("bpe"), words(F.col("text")).alias("words"),
        F.col("lean").isNotNull().alias("revised"), counts.tokens_column("lean", BPE_RANKS).alias("lean_bpe"), words(F.col("lean")).alias("lean_words")), "counts")
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    versions = {"byte_bpe_50k": "bpe", "words": "words"}
    rollup = counts.Rollup(spark, scratch_path(spark, "rollup"))
    marked = docs.join(labels, "doc_id")
    lean_changes = counts.changes(marked.filter("quality = 0 AND revised"), "put", {"byte_bpe_50k": "lean_bpe", "words": "lean_words"})
    rollup.commit(1, counts.changes(docs, "put", versions))
    rollup.commit(2, lean_changes)
    rollup.commit(2, lean_changes)
    rollup.commit(3, counts.changes(marked.filter("toxic = 1"), "delete", versions))
    return rollup.totals()


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(read_table(spark, sf_dir, "documents"), window=13)


ORACLES["op8_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM w),
v AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win FROM s),
m AS (SELECT win, min(doc_id) AS least FROM v GROUP BY win),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM v JOIN m USING (win) WHERE doc_id > least),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
k AS (SELECT x.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept FROM x ANTI JOIN c USING (doc_id, j) GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

ORACLES["op1_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM d),
v AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS win FROM s),
m AS (SELECT win FROM v GROUP BY win HAVING count(*) > 1),
r AS (SELECT doc_id, i FROM v JOIN m USING (win)),
p AS (SELECT doc_id, i, CASE WHEN i <= max(i + 200) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM r),
q AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM p),
t AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM q GROUP BY doc_id, run),
g AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM t),
k AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS ending,
  string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM g JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(ending, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

#: The joint settings of op2 again as SQL: the cutoff of every rule in every setting, and its statistic.
_Q_RULES = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, {j} AS j, CAST({grid[math.ceil(j * len(grid) / 11) - 1]} AS DOUBLE) AS cutoff" for name, _, grid in quality.RULES for j in range(1, 12))
_Q_STATS = " UNION ALL ".join(
    f"SELECT doc_id, stratum, '{name}' AS rule, CASE WHEN {e.split('/')[1]} > 0 THEN {e} ELSE 0.0 END AS stat FROM f" for name, e, _ in quality.RULES)
ORACLES["op2_quality_rules"] = rf"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
v AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
m AS (SELECT doc_id, win FROM v GROUP BY doc_id, win HAVING count(*) > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS j FROM v JOIN m USING (doc_id, win)) GROUP BY doc_id),
b AS (SELECT doc_id, stratum, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS BIGINT) AS n_upper,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
s AS ({_Q_STATS}), g AS ({_Q_RULES}),
l AS (SELECT doc_id, max(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
h AS (SELECT doc_id, stratum, j, bool_or(stat > cutoff) AS hit FROM s JOIN g USING (rule) GROUP BY ALL),
k AS (SELECT stratum, j, count(*) FILTER (good) AS n, count(*) FILTER (good AND hit) AS k, count(*) FILTER (NOT good AND hit) AS hit
  FROM h JOIN l USING (doc_id) GROUP BY ALL),
p AS (SELECT *, CASE WHEN k > n * 0.05 THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
    lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.05) + (n - i) * ln(0.95)))) END AS tail FROM k),
o AS (SELECT *, min(CASE WHEN tail <= 0.05 / (SELECT count(DISTINCT stratum) FROM k) THEN 1 ELSE 0 END)
    OVER (PARTITION BY stratum ORDER BY j ROWS UNBOUNDED PRECEDING) AS ok FROM p),
z AS (SELECT stratum, arg_max(j, (hit - k) * 1000 - j) AS j FROM o WHERE ok = 1 AND hit > k GROUP BY stratum),
bad AS (SELECT doc_id FROM h JOIN z USING (stratum, j) WHERE hit)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM f
"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"), min_count=100, longest=5, top=2000)


ORACLES["op11_collocations"] = r"""
WITH p AS (SELECT lang, pid, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws
  FROM (SELECT lang, piece, row_number() OVER () AS pid FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents))),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p),
g AS (SELECT lang, k, ws[i:i + k - 1] AS g FROM s, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(ws)),
c AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
h AS (SELECT * FROM c WHERE f >= 100),
cut AS (SELECT h.lang, h.k, h.g, h.f AS a, j, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * h.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM h, (SELECT unnest(range(1, 5)) AS j), h l, h r, t
  WHERE h.k >= 2 AND j < h.k AND l.lang = h.lang AND r.lang = h.lang AND t.lang = h.lang AND l.g = h.g[1:j] AND r.g = h.g[j + 1:h.k]),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
part AS (SELECT DISTINCT h.lang, h.g[i:i + m - 1] AS g, h.f FROM h, (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(2, 5)) AS m)
  WHERE m < h.k AND i + m - 1 <= h.k),
ok AS (SELECT low.* FROM low ANTI JOIN part ON part.lang = low.lang AND part.g = low.g AND 100 * part.f >= 100 * low.a),
z AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM ok)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM z) WHERE rank <= 2000
"""


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    return conversations.report(conversations.repair(conversations.damage(rows)), rows.select("conv_id"))


def _repair_sql() -> str:
    """The damage, the faults, and the cheapest edits from the last row backwards:
    ``v`` has {cost, audit, lines} to the end from the states start, system, user,
    assistant (1 to 4)."""
    follows, names, far = {1: 3, 2: 3, 3: 4, 4: 3}, {3: "user", 4: "assistant"}, 10 ** 9
    before, closed = [], []
    for st, to in follows.items():
        keep = lambda ini, t: f"{{'c': CASE WHEN ini = '{ini}' THEN e + v[{t}].c ELSE {far} END, 'a': 'K' || v[{t}].a, 'l': chr(10) || role || ':' || text || v[{t}].l}}"
        opts = [f"{{'c': 2 + v[{st}].c, 'a': 'D' || v[{st}].a, 'l': v[{st}].l}}",
                f"{{'c': 1 + e + v[{to}].c, 'a': 'R' || v[{to}].a, 'l': chr(10) || '{names[to]}:' || text || v[{to}].l}}", keep(names[to][0], to)]
        before.append(f"list_sort([{', '.join(opts + ([keep('s', 2)] if st == 1 else []))}])[1]")
        then = follows[to]
        closed.append(f"list_sort([b[{st}], {{'c': 5 + b[{to}].c, 'a': 'I' || b[{to}].a, 'l': chr(10) || '{names[to]}:' || b[{to}].l}}, "
                      f"{{'c': 10 + b[{then}].c, 'a': 'II' || b[{then}].a, 'l': chr(10) || '{names[to]}:' || chr(10) || '{names[then]}:' || b[{then}].l}}])[1]")
    return rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(key) + 1), lambda p: CAST(ord(key[p]) AS BIGINT))),
    lambda x, y: list_reduce(list_prepend(xor(x, y), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda w, z: CASE WHEN w & 1 = 1 THEN xor(w >> 1, 3988292384) ELSE w >> 1 END)),
    4294967295) % 20 AS kind FROM k),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) FROM h WHERE kind <> 0),
n AS (SELECT conv_id, turn, role, text, role[1] AS ini, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM d),
f AS (SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    regexp_matches(text, '[^.!? 	-
][ 	-
]*\z') AS unended, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM n),
o AS (SELECT *, CASE WHEN blank OR seen THEN {far} WHEN unended THEN 5 ELSE 0 END AS e FROM f),
t AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND seen) AS duplicate,
    count(*) FILTER (NOT blank AND NOT seen AND unended) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM o GROUP BY conv_id),
s AS (SELECT conv_id, n + 1 AS i, [{{'c': 0::BIGINT, 'a': '', 'l': ''}}, {{'c': 10, 'a': 'II', 'l': chr(10) || 'user:' || chr(10) || 'assistant:'}},
    {{'c': 5, 'a': 'I', 'l': chr(10) || 'assistant:'}}, {{'c': 0, 'a': '', 'l': ''}}] AS v FROM t
  UNION ALL
  SELECT conv_id, i, [{', '.join(closed)}] FROM (
    SELECT s.conv_id, o.i, [{', '.join(before)}] AS b FROM s JOIN o ON o.conv_id IS NOT DISTINCT FROM s.conv_id AND o.i = s.i - 1)),
z AS (SELECT conv_id, v[1] AS v FROM s WHERE i = 1)
SELECT c.conv_id, coalesce(t.gaps, 0) AS gaps, coalesce(t.blank, 0) AS blank, coalesce(t.duplicate, 0) AS duplicate, coalesce(t.truncated, 0) AS truncated,
  coalesce(t.illegal, 0) AS illegal, coalesce(z.v.c, 0) AS cost, coalesce(z.v.a, '') AS audit, sha256(substr(coalesce(z.v.l, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLES["op13_conversation_repair"] = _repair_sql()


@query
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=5, percent=85)
