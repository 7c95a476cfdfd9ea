"""URL filters: a broadcast trie over reversed host labels and path segments,
where the longest matching rule decides between allow and block."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most characters of all rules that may be broadcast (checked before the broadcast).
MAX_RULE_CHARS = 64 << 20
Rule = tuple[str, str, str]  # verdict, host, path


class RuleTrie:
    """Edges are host labels from the right, then path segments.

    Below the host every node keeps the rules that end inside a segment as
    prefixes, so that a path rule fits exactly the paths that start with it.
    A node is (children, path root or prefixes, rule)."""

    def __init__(self, rules: list[Rule]):
        self.root: dict = {}
        for verdict, host, path in sorted(rules):  # allow before block: at the same place block stays
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(("h", label), {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault(("p", segment), {})
            node.setdefault("ends", {})[last] = (host + path, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest fitting rule: most host labels first,
        then the longest path."""
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.get(("h", label))
            if node is None:
                break
            best = self._path(node, path) or best
        return best

    @staticmethod
    def _path(node: dict, path: str) -> tuple[str, str] | None:
        best, segments = None, path.split("/")
        for i, segment in enumerate(segments):
            fits = [e for e in node.get("ends", ()) if segment.startswith(e)]
            if fits:
                best = node["ends"][max(fits, key=len)]
            node = node.get(("p", segment)) if i + 1 < len(segments) else None
            if node is None:
                break
        return best


def split_url(df: DataFrame, url_col: str) -> DataFrame:
    """``df`` with ``__host`` and ``__path``: the host is what follows the first
    ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path what
    follows up to ``?``, ``#`` or the end. Null, or no ``://``: both empty."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(__u, instr(__u, '://') + 3)")).otherwise(F.lit(""))
    return df.withColumn("__u", url).withColumn("__rest", rest) \
        .withColumn("__host", F.translate(F.regexp_extract("__rest", r"^([^/?#]*)", 1),
                                          "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) \
        .withColumn("__path", F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1)).drop("__u", "__rest")


def url_filter(df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for each input row.

    ``rules``: (``allow`` or ``block``, host, path). A rule fits its host and all
    subdomains if the url's path starts with its path; the longest wins, more
    host labels before a longer path; the same rule in both lists blocks. Without
    a fitting rule: rule null and ``default``. A null url has an empty host and
    path, to which only a rule with both empty fits. Repeated rows and null ids
    stay; other columns are not read. The trie is built once from the broadcast
    rules in each Python worker; its size is checked against MAX_RULE_CHARS.
    """
    size = sum(len(h) + len(p) for _, h, p in rules)
    if size > MAX_RULE_CHARS:
        raise ValueError(f"rules of {size} characters are over the broadcast bound {MAX_RULE_CHARS}")
    shared = df.sparkSession.sparkContext.broadcast(RuleTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def decide(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        trie = shared.value
        found = [trie.find(h, p) or (None, default) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    parts = split_url(df.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url")), "__url")
    return parts.withColumn("__v", decide("__host", "__path")).select(
        F.col("__id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"),
        F.col("__v.rule").alias("rule"), F.col("__v.verdict").alias("verdict"))
