"""Token counts as delta-maintained rollups.

Two tables in a shared folder: the state log (per batch, the documents' new
counts) and the deltas (per batch, signed sums by source, language and tokenizer
version). A batch of changes is joined with the current state of its documents;
what it adds and what it takes away becomes one signed row per group. Totals are
the sums of all committed deltas; documents are never counted again.

A batch is committed by one atomic rename of its finished folder to its batch
id. Committing the same id again changes nothing, so a job that died may be run
again; what an unfinished one wrote has another name and is not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ["source", "lang", "version"]
KEY = ["doc_id", "version"]
STATE = "doc_id long, version string, source string, lang string, tokens long, live boolean, batch long"
DELTA = "source string, lang string, version string, d_docs long, d_tokens long, batch long"
_encoders: dict = {}


def tokens_column(text_col, ranks_path: str):
    """Tokens of each text under the byte-level BPE vocabulary at ``ranks_path``."""
    import public_tokenizers
    pattern = public_tokenizers.PATTERN

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if ranks_path not in _encoders:
            import base64

            import tiktoken
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            _encoders[ranks_path] = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        enc = _encoders[ranks_path]
        for s in texts:
            yield pd.Series([len(enc.encode_to_numpy(t, disallowed_special=())) if t else 0 for t in s], dtype="int64")

    return count(text_col)


class Rollup:
    """Token totals under ``path`` (a folder that all machines share)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def batches(self) -> list[int]:
        """Committed batch ids."""
        root = self._path(f"{self.path}/batches")
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch="))

    def _read(self, kind: str, schema: str) -> DataFrame:
        found = self.batches()
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/batches/batch={b}/{kind}" for b in found])

    def state(self) -> DataFrame:
        """The last committed counts of every document and version."""
        last = F.max_by(F.struct(*GROUP[:2], "tokens", "live"), "batch").alias("s")
        return self._read("state", STATE).groupBy(*KEY).agg(last).filter("s.live").select(*KEY, "s.source", "s.lang", "s.tokens")

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_tokens) over all committed batches;
        groups whose documents are all gone are left out."""
        return self._read("delta", DELTA).groupBy(*GROUP) \
            .agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens")).filter("n_docs <> 0 OR n_tokens <> 0")

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply ``changes(doc_id, version, source, lang, tokens, op)`` once.

        op ``put`` inserts a document or revises its counts (source and language
        may change too); ``delete`` takes it out; a document that is not there is
        not missed. Several changes of one document in a batch: a delete wins over puts,
        among puts the largest (tokens, source, lang). Rows without doc_id, version or op are ignored; a null
        source or language is a group of its own; null tokens count as zero. False if the batch
        is already committed. Ids must rise: a smaller one than the greatest committed is an
        error, since the totals of the batches after it were counted without it. Extra
        columns are not read. Of two writers of one id one wins, and the other gets False."""
        found = self.batches()
        if batch in found:
            return False
        if found and batch < found[-1]:
            raise ValueError(f"batch {batch} comes after batch {found[-1]}; ids must rise")
        target = self._path(f"{self.path}/batches/batch={batch}")
        tmp = f"{self.path}/unfinished/{batch}-{uuid.uuid4().hex[:12]}"
        pick = F.max(F.struct((F.col("op") == "delete").alias("gone"), F.coalesce("tokens", F.lit(0).cast("long")).alias("tokens"), *GROUP[:2])).alias("n")
        new = changes.filter("doc_id IS NOT NULL AND version IS NOT NULL AND op IN ('put', 'delete')") \
            .groupBy(*KEY).agg(pick).select(*KEY, "n.gone", "n.tokens", "n.source", "n.lang")
        old = self.state().select(*KEY, F.col("source").alias("o_source"), F.col("lang").alias("o_lang"), F.col("tokens").alias("o_tokens"))
        both = new.join(old, KEY, "left")
        had = F.col("o_tokens").isNotNull()
        both.select(*KEY, F.when(had, F.struct("o_source", "o_lang", "o_tokens")).alias("o"), "gone", "tokens", "source", "lang") \
            .write.parquet(f"{tmp}/change")
        done = self.spark.read.parquet(f"{tmp}/change")
        done.select(*KEY, "source", "lang", "tokens", (~F.col("gone")).alias("live"), F.lit(batch).cast("long").alias("batch")) \
            .write.parquet(f"{tmp}/state")
        plus = F.when(~F.col("gone"), F.struct("source", "lang", F.col("tokens").alias("t"), F.lit(1).cast("long").alias("n")))
        minus = F.when(F.col("o").isNotNull(), F.struct(F.col("o.o_source").alias("source"), F.col("o.o_lang").alias("lang"),
                                                         (-F.col("o.o_tokens")).alias("t"), F.lit(-1).cast("long").alias("n")))
        done.select("version", F.explode(F.array_compact(F.array(plus, minus))).alias("d")) \
            .groupBy(F.col("d.source").alias("source"), F.col("d.lang").alias("lang"), "version") \
            .agg(F.sum("d.n").alias("d_docs"), F.sum("d.t").alias("d_tokens")) \
            .withColumn("batch", F.lit(batch).cast("long")).write.parquet(f"{tmp}/delta")
        self._fs.mkdirs(target.getParent())
        self._fs.delete(self._path(f"{tmp}/change"), True)
        # a rename onto an existing folder moves into it on some file systems
        marker = "by-" + tmp.rsplit("-", 1)[1]
        self._fs.mkdirs(self._path(f"{tmp}/{marker}"))
        if not self._fs.exists(target) and self._fs.rename(self._path(tmp), target) and self._fs.exists(self._path(f"{target}/{marker}")):
            return True
        for lost in (tmp, f"{target}/{tmp.rsplit('/', 1)[1]}"):
            self._fs.delete(self._path(lost), True)
        return False


def changes(rows: DataFrame, op: str, counts: dict[str, str]) -> DataFrame:
    """``rows`` with one count column per tokenizer version, as change rows."""
    return rows.select("doc_id", "source", "lang", F.lit(op).alias("op"), F.explode(F.array(*[
        F.struct(F.lit(v).alias("version"), F.col(c).cast("long").alias("tokens")) for v, c in counts.items()])).alias("c")) \
        .select("doc_id", "c.version", "source", "lang", "c.tokens", "op")
