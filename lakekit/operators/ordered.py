"""Row-order computations that stay balanced when one key holds most of the rows.

A window partitioned by a key puts all rows of that key into one task. Keys with at most
`run_rows` rows are handled that way. Larger keys are range-partitioned by (key, order) into
*runs* of about `run_rows` rows; each run is a window partition of its own, and what a run
needs from the runs before it (a few preceding rows, or running totals) is computed from small
per-run summaries. The result is the same as that of the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lakekit.session import materialize

RUN_ROWS = 5_000_000


def default_run_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.lakekit.runRows", str(RUN_ROWS)))


class Ordered:
    """The rows of `df` in ascending `order` within `keys` (no keys: the whole table)."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], run_rows: int | None = None):
        self.keys, self.order = list(keys), list(order)
        # Equal rows keep their input order, in both kinds of window, and may span runs.
        counted, df = df, df.withColumn("_tie", F.monotonically_increasing_id())
        self.cold: DataFrame | None = df
        self.hot: DataFrame | None = None
        self.runs = 0
        self._settled = True
        limit = run_rows or default_run_rows(df)
        counts = counted.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > limit)
        key = F.struct(*keys) if keys else F.lit(0)
        heavy = counts.select(key.alias("_key"), "_rows")
        # At most (rows of df / limit) entries, so both the driver and a broadcast can hold them.
        found = heavy.collect()
        if not found:
            return
        keyed = df.withColumn("_key", key)
        if keys:
            names = df.sparkSession.createDataFrame(found, heavy.schema).select("_key")
            self.cold = keyed.join(F.broadcast(names), "_key", "left_anti").drop("_key")
            keyed = keyed.join(F.broadcast(names), "_key", "left_semi")
        else:
            self.cold = None
        self.runs = math.ceil(sum(row["_rows"] for row in found) / limit)
        ranged = keyed.repartitionByRange(self.runs, *self.keys, *self.order, "_tie")
        # Written out so that the run numbers stay fixed for all later steps.
        self.hot = materialize(ranged.withColumn("_run", F.spark_partition_id()), "runs")

    def _plain(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order, "_tie")

    def _in_run(self) -> WindowSpec:
        return Window.partitionBy("_run", "_key").orderBy(*self.order, "_tie")

    def _by_run(self, df: DataFrame) -> DataFrame:
        """One task for about one run, whatever number of shuffle partitions the session has."""
        return df.repartition(self.runs, "_run", "_key")

    def _settle(self) -> DataFrame:
        """The hot rows, written out if a step before has only described them."""
        if not self._settled:
            self.hot = materialize(self.hot, "runs")
        self._settled = False
        return self.hot

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Ordered:
        """Apply a row-by-row change."""
        self.cold = None if self.cold is None else change(self.cold)
        self.hot = None if self.hot is None else change(self.hot)
        return self

    def sliding(self, before: int, add: Callable[[DataFrame, WindowSpec], DataFrame]) -> Ordered:
        """Add columns that look back at most `before` rows, given the window to use."""
        if self.cold is not None:
            self.cold = add(self.cold, self._plain())
        if self.hot is None:
            return self
        hot = self._settle()
        newest = Window.partitionBy("_run", "_key").orderBy(*[F.desc(c) for c in [*self.order, "_tie"]])
        tail = hot.withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= before)
        row = F.struct(*[c for c in hot.columns if c != "_run"])
        seen = Window.partitionBy("_key").orderBy("_run", F.desc("_back")).rowsBetween(1 - before, 0)
        following = Window.partitionBy("_key").orderBy("_run")
        carried = (
            tail.withColumn("_carry", F.collect_list(row).over(seen))
            .filter(F.col("_back") == 1)
            .select("_carry", F.lead("_run").over(following).alias("_run"))
            .filter(F.col("_run").isNotNull())
            .select("_run", F.explode("_carry").alias("_row"))
            .select("_run", "_row.*", F.lit(True).alias("_carried"))
        )
        both = self._by_run(hot.withColumn("_carried", F.lit(False)).unionByName(carried))
        self.hot = add(both, self._in_run()).filter(~F.col("_carried")).drop("_carried")
        return self

    def running(self, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None) -> Ordered:
        """Add running totals, and running last non-null values, up to and including each row."""
        sums, lasts = sums or {}, lasts or {}

        def local(df: DataFrame, spec: WindowSpec, prefix: str = "") -> DataFrame:
            upto = spec.rowsBetween(Window.unboundedPreceding, 0)
            return df.withColumns(
                {prefix + n: F.coalesce(F.sum(c).over(upto), F.lit(0)) for n, c in sums.items()}
                | {prefix + n: F.last(c, ignorenulls=True).over(upto) for n, c in lasts.items()}
            )

        if self.cold is not None:
            self.cold = local(self.cold, self._plain())
        if self.hot is None:
            return self
        hot = self._settle()
        at = F.struct(*self.order, "_tie")
        summary = hot.groupBy("_run", "_key").agg(
            *[F.sum(c).alias("_before_" + n) for n, c in sums.items()],
            *[F.max_by(c, F.when(c.isNotNull(), at)).alias("_before_" + n) for n, c in lasts.items()],
        )
        earlier = Window.partitionBy("_key").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
        carry = summary.select(
            "_run",
            "_key",
            *[F.sum("_before_" + n).over(earlier).alias("_before_" + n) for n in sums],
            *[F.last("_before_" + n, ignorenulls=True).over(earlier).alias("_before_" + n) for n in lasts],
        )
        joined = local(self._by_run(hot).join(carry, ["_run", "_key"]), self._in_run(), "_local_")
        self.hot = joined.withColumns(
            {n: F.col("_local_" + n) + F.coalesce("_before_" + n, F.lit(0)) for n in sums}
            | {n: F.coalesce("_local_" + n, "_before_" + n) for n in lasts}
        ).drop(*["_local_" + n for n in [*sums, *lasts]], *["_before_" + n for n in [*sums, *lasts]])
        return self

    def result(self) -> DataFrame:
        if self.hot is None:
            return self.cold.drop("_tie")
        hot = self.hot.drop("_run", "_key", "_tie")
        return hot if self.cold is None else self.cold.drop("_tie").unionByName(hot)
