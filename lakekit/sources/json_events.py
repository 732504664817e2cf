"""JSON events: a string `key` and a JSON `value`, as in a message topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Microseconds, which the default formats cut off.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def decode_events(df: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """Read the JSON in `value` into columns; works on batch and streaming frames alike."""
    others = [c for c in df.columns if c != value]
    parsed = F.from_json(F.col(value).cast("string"), schema, TIMES)
    return df.select(*others, parsed.alias("_event")).select(*others, "_event.*")


def encode_events(df: DataFrame, key: str) -> DataFrame:
    """Every row as `key` (text of that column) and `value` (JSON of all columns)."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*"), TIMES).alias("value"))
