import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null ids and texts, empty and blank texts, repeated rows, a long text, and columns whose names clash with the operators' own."""
    long = " ".join(f"word{i % 977} of{i % 13} text{i % 31}" for i in range(30000))
    rows = [(1, "The quick brown fox jumps over the lazy dog. " * 12), (1, "The quick brown fox jumps over the lazy dog. " * 12),
            (2, None), (3, ""), (4, " \n\t "), (None, "The quick brown fox jumps over the lazy dog. " * 12), (None, None), (5, "one"),
            (6, long), (7, "é€🙂 " * 100), (8, "\x00 zero \x0b bytes")]
    df = spark.createDataFrame([(i, t, "en" if k % 2 else None, "s") for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string")
    clash = ["row", "id", "raw", "fp", "g", "n_words", "kept", "fingerprint", "component_id", "rule", "verdict", "n_chars", "key", "__id", "digest", "n_bytes"]
    return df.withColumns({c: F.lit(-1) for c in clash})
