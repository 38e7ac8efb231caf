"""Shared schemas and column-name defaults."""

from pyspark.sql import types as T

# Persisted range tables (input and output): set number plus a closed range.
RANGES_SCHEMA = T.StructType(
    [
        T.StructField("set_id", T.IntegerType(), False),
        T.StructField("begin", T.LongType(), False),
        T.StructField("end", T.LongType(), False),
    ]
)

PAIRS_SCHEMA = T.StructType(
    [
        T.StructField("begin_text", T.StringType(), True),
        T.StructField("end_text", T.StringType(), True),
    ]
)

REJECT_MALFORMED = "malformed"
REJECT_REVERSED = "reversed"

DEFAULT_KEYS = ("set_id",)


def as_keys(keys) -> list[str]:
    """Normalise a key argument (None, str or sequence) to a list of names."""
    if keys is None:
        return []
    if isinstance(keys, str):
        return [keys]
    return list(keys)
