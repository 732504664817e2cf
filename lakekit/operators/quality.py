"""Data-quality rules and the gate before a write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    violated: Column


class QualityError(ValueError):
    """Raised when a gate finds violations."""


def expect_not_null(col: str) -> Rule:
    return Rule(f"null_{col}", F.col(col).isNull())


def expect_min(col: str, low: float) -> Rule:
    return Rule(f"low_{col}", F.col(col) < low)


def violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that break each rule, counted for all rules in one pass."""
    return df.agg(*[F.count_if(r.violated).alias(r.name) for r in rules])


def gate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """`df` itself if no row breaks a rule, else an error. Reads only the columns of the rules."""
    counts = violations(df, rules).first()
    broken = {r.name: counts[r.name] for r in rules if counts[r.name]}
    if broken:
        raise QualityError(f"data quality check failed: {broken}")
    return df
