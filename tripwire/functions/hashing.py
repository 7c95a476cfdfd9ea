"""Row encoding and salted SHA-256 row hashes.

Encoding and hash are native Catalyst expressions, so hashing stays inside
whole-stage codegen. The salt comes from a one-row table, not from a literal:
it appears in no plan, hence in no event log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.schema import CONTENT_CENTS

NULL = "\\N"
_SALT = "_salt"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _token(text: Column) -> Column:
    """A value's text with ``\\`` and ``,`` escaped; NULL is the token ``\\N``,
    which no escaped text equals."""
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(","), F.lit("\\,"))
    return F.coalesce(escaped, F.lit(NULL))


def encode_row(cols: Sequence = CONTENT_CENTS) -> Column:
    """Canonical, engine-independent encoding: values as text, comma-joined.

    Integer cents / decimals print identically everywhere, so this is the default
    encoding (a scaled float can flip its last printed digit between engines).
    Different rows have different encodings: a NULL has its own token and
    separators inside a value are escaped.
    """
    return F.concat_ws(",", *[_token(_c(c).cast("string")) for c in cols])


def encode_row_fixed6(cols: Sequence) -> Column:
    """The reference's float encoding: every value as ``%.6f``, comma-joined; NULL as in ``encode_row``."""
    return F.concat_ws(",", *[F.when(_c(c).isNull(), F.lit(NULL)).otherwise(F.format_string("%.6f", _c(c).cast("double")))
                              for c in cols])


def hash_rows(df: DataFrame, cols: Sequence, salt: str, out: str = "row_hash", fixed6: bool = False) -> DataFrame:
    """J1+J2: add hex SHA-256 of (encoding || salt)."""
    enc = encode_row_fixed6(cols) if fixed6 else encode_row(cols)
    one = df.sparkSession.createDataFrame([(salt,)], f"{_SALT} string")
    return df.crossJoin(F.broadcast(one)).withColumn(out, F.sha2(F.concat(enc, F.col(_SALT)), 256)).drop(_SALT)
