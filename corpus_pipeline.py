"""Corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark
leaks, tokens. Each stage works on all rows its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tripwire.llm import bpe, decontam, quality, simhash, suffix
from tripwire.llm.common import drop_path, read_table, recording, write_once
from tripwire.llm.queries import BPE_JSON

Stage = Callable[..., DataFrame]
_scratch: list[str] = []
#: Rows of an Arrow batch between Spark and Python. Documents have kilobytes each: Spark's
#: 10,000 rows are tens of MB, held several times over by each task and its Python worker.
BATCH_ROWS, BATCH_CONF = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def stage(fn: Stage) -> Stage:
    """A stage begins when its predecessor's result is written, so it first drops
    the scratch tables of the stages before it (but what ``docs`` itself reads):
    those in ``scratch``, the list of its run, or else of the stages called alone.
    Arrow batches of the session hold at most BATCH_ROWS rows from then on."""
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: list[str] | None = None) -> DataFrame:
        paths = _scratch if scratch is None else scratch
        read = docs.inputFiles()
        done = [p for p in paths if not any(p.rsplit("/", 1)[1] in f for f in read)]
        drop_path(spark, *done)
        paths[:] = [p for p in paths if p not in done]
        if not 0 < int(spark.conf.get(BATCH_CONF)) <= BATCH_ROWS:
            spark.conf.set(BATCH_CONF, BATCH_ROWS)
        with recording(paths):
            return fn(spark, docs, sf_dir)

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled quality rules keep."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, distance=2)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of strings of 200 bytes that occur twice."""
    return suffix.drop_repeats(docs, length=200)


@stage
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens and the digests of its ids and of their decoding."""
    return bpe.bpe_round_trip(docs, BPE_JSON)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks), ("tokens", tokens),
]

#: Tokens, suffix sorting and the random walks of decontamination are not expressible in SQL;
#: tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; each result but the last is written and reread as the next one's documents."""
    docs, scratch = read_table(spark, sf_dir, "documents"), []  # of this run only: its rows read them after other runs too
    for name, step in STAGES[:-1]:
        out = step(spark, docs, sf_dir, scratch)
        with recording(scratch):
            docs, _ = write_once(out, f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir, scratch)
