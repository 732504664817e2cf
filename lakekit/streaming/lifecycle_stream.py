"""The job lifecycle on a stream, as a table of job states by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.lifecycle import MAX_RETRIES, advance
from lakekit.operators.windows import first_rows
from lakekit.streaming.streams import read_parts, run_each


def newest_states(versions: DataFrame) -> DataFrame:
    """Of states with the `batch` (a number) that wrote them, the newest of each job."""
    return first_rows(versions, ["job_id"], [F.desc("batch")]).drop("batch")


def run_lifecycle(
    sdf: DataFrame,
    path: str,
    checkpoint: str,
    max_retries: int = MAX_RETRIES,
    guard_terminal: bool = False,
) -> None:
    """Write the states of the jobs that a micro-batch changes to `path/batch=N`, until the input is used up.

    Batch N starts from the newest states of the batches before it, so running a batch again gives the same result. Jobs
    without new events are not written again; `newest_states` gives the present state of all jobs.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = None
        if batch_id:
            earlier = read_parts(spark, path).filter(F.col("batch") < batch_id)
            known = newest_states(earlier.join(batch.select("job_id").distinct(), "job_id", "left_semi"))
        states = advance(known, batch, max_retries, guard_terminal)
        states.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    run_each(sdf, save, checkpoint)
