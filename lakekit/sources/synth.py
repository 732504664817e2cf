"""Generated tables: each value is a function of (seed, column, row id) only.

Values therefore do not depend on partitioning, and a lost task is recomputed to the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Kind = Callable[[Column, int, str], Column]

_BITS = 52  # exact in a double


def _draw(row: Column, seed: int, name: str) -> Column:
    """Uniform in [0, 1)."""
    hashed = F.xxhash64(F.lit(seed), F.lit(name), row)
    return F.shiftrightunsigned(hashed, 64 - _BITS).cast("double") / float(2**_BITS)


def sequence(start: int = 0) -> Kind:
    return lambda row, seed, name: row + start


def uniform_int(low: int, high: int) -> Kind:
    """Both ends included."""
    return lambda row, seed, name: (F.floor(_draw(row, seed, name) * (high - low + 1)) + low).cast("int")


def uniform(low: float, high: float, digits: int | None = 2) -> Kind:
    def kind(row: Column, seed: int, name: str) -> Column:
        value = _draw(row, seed, name) * (high - low) + low
        return value if digits is None else F.round(value, digits)

    return kind


def choice(values: list[str]) -> Kind:
    pick = uniform_int(1, len(values))
    return lambda row, seed, name: F.element_at(F.array(*[F.lit(v) for v in values]), pick(row, seed, name))


def gauss(mean: float, deviation: float, digits: int | None = None) -> Kind:
    """Normal values by the polar form of two uniform draws."""

    def kind(row: Column, seed: int, name: str) -> Column:
        radius = F.sqrt(F.log(1 - _draw(row, seed, name + ".r")) * -2)
        value = radius * F.cos(_draw(row, seed, name + ".a") * (2 * math.pi)) * deviation + mean
        return value if digits is None else F.round(value, digits)

    return kind


def prefixed_int(prefix: str, low: int, high: int) -> Kind:
    return lambda row, seed, name: F.concat(F.lit(prefix), uniform_int(low, high)(row, seed, name).cast("string"))


def padded(prefix: str, width: int = 6) -> Kind:
    """`txn_000042`; longer numbers are not cut."""
    return lambda row, seed, name: F.format_string(f"{prefix}%0{width}d", row)


def modular(prefix: str, n: int, suffix: str = "") -> Kind:
    """Planned duplicates: `n` distinct values in turn."""
    return lambda row, seed, name: F.concat(F.lit(prefix), (row % n).cast("string"), F.lit(suffix))


def hourly(base: str) -> Kind:
    """One hour for each row, from a base instant."""
    return lambda row, seed, name: F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(hours=row.cast("int"))


def constant(value: object) -> Kind:
    return lambda row, seed, name: F.lit(value)


def synth_columns(df: DataFrame, row: str, spec: dict[str, Kind], seed: int = 0) -> DataFrame:
    """The columns of `spec` for each row number in column `row` of `df`."""
    return df.select(*[kind(F.col(row), seed, name).alias(name) for name, kind in spec.items()])


def synth(spark: SparkSession, n: int, spec: dict[str, Kind], seed: int = 0) -> DataFrame:
    """A table of `n` rows, generated in parallel on the executors."""
    return synth_columns(spark.range(n), "id", spec, seed)
