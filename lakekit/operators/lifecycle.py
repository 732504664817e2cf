"""Job lifecycle: the state of each job after each of its events.

Events have `job_id`, `event_id`, `ts`, `status` (null for a cancel request), `is_cancel` and
`error_message`, and may have `max_retries` (the job's own limit, on each of its events) and
`container_id` (kept while later ones are empty); both are then part of the state. The state is written in closed form over running counts and running last
values, so no row-by-row fold is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.operators.ordered import Ordered
from lakekit.operators.windows import first_rows

# The states of a job.
PENDING = "PENDING"
QUEUED = "QUEUED"
PROVISIONING = "PROVISIONING"
RUNNING = "RUNNING"
SUCCESS = "SUCCESS"
FAILED = "FAILED"
CANCELLED = "CANCELLED"
DEAD = "DEAD"
TERMINAL = [SUCCESS, DEAD, CANCELLED]
COMPLETING = [SUCCESS, FAILED, CANCELLED, DEAD]
MAX_RETRIES = 3

ORDER = ["ts", "event_id"]
STATE = ["status_after", "retry_count", "started_at", "completed_at", "last_error"]
OPTIONAL = ["max_retries", "container_id"]


def _resting(status: Column, failures: Column, max_retries: Column) -> Column:
    """The state a status update leaves: a failure is queued again while retries remain."""
    retried = F.when(failures <= max_retries, QUEUED).otherwise(DEAD)
    return F.when(status == FAILED, retried).otherwise(status)


def lifecycle(
    events: DataFrame,
    max_retries: int = MAX_RETRIES,
    guard_terminal: bool = False,
    run_rows: int | None = None,
) -> DataFrame:
    """Every event with the state after it.

    Without `guard_terminal`, a late status update overwrites a final state; with it, the first
    final state stays.
    """
    return _fold(_new_rows(events), max_retries, guard_terminal, run_rows)


def final_states(events: DataFrame, max_retries: int = MAX_RETRIES, guard_terminal: bool = False) -> DataFrame:
    """The state of each job after its last event."""
    return advance(None, events, max_retries, guard_terminal)


def advance(
    states: DataFrame | None,
    events: DataFrame,
    max_retries: int = MAX_RETRIES,
    guard_terminal: bool = False,
    run_rows: int | None = None,
) -> DataFrame:
    """Job states after `events`, given the `states` (from this function) before them.

    A known state enters as one row ahead of the job's new events.
    """
    rows = _new_rows(events)
    if states is not None:
        rows = _known_rows(states).unionByName(rows)
    folded = _fold(rows, max_retries, guard_terminal, run_rows, keep=["_new"])
    return first_rows(folded, ["job_id"], [F.desc(c) for c in ["_new", *ORDER]]).drop("_new")


def _new_rows(events: DataFrame) -> DataFrame:
    status, ts = F.col("status"), F.col("ts")
    return events.select(
        "job_id",
        *ORDER,
        F.lit(1).alias("_new"),
        "status",
        "is_cancel",
        "error_message",
        F.when(status == FAILED, 1).otherwise(0).alias("_failed"),
        F.when(status == RUNNING, ts).alias("_started"),
        F.when(status.isin(COMPLETING), ts).alias("_completed"),
        *[F.col(c) for c in OPTIONAL if c in events.columns],
    )


def _known_rows(states: DataFrame) -> DataFrame:
    return states.select(
        "job_id",
        *ORDER,
        F.lit(0).alias("_new"),
        F.col("status_after").alias("status"),
        F.lit(False).alias("is_cancel"),
        F.col("last_error").alias("error_message"),
        F.col("retry_count").cast("int").alias("_failed"),
        F.col("started_at").alias("_started"),
        F.col("completed_at").alias("_completed"),
        *[F.col(c) for c in OPTIONAL if c in states.columns],
    )


def _fold(
    rows: DataFrame, max_retries: int, guard_terminal: bool, run_rows: int | None, keep: list[str] = ()
) -> DataFrame:
    update = ~F.col("is_cancel")
    own = [c for c in OPTIONAL if c in rows.columns]
    limit = F.coalesce("max_retries", F.lit(max_retries)) if "max_retries" in own else F.lit(max_retries)
    if "container_id" in own:
        rows = rows.withColumnRenamed("container_id", "_container")
    counted = Ordered(rows, ["job_id"], ["_new", *ORDER], run_rows).running(
        sums={"_failures": F.col("_failed")}, lasts={"_last_status": F.when(update, F.col("status"))}
    )
    resting = F.coalesce(_resting(F.col("_last_status"), F.col("_failures"), limit), F.lit(PENDING))
    counted = counted.map(lambda d: d.withColumn("_resting", resting))
    marks = {"container_id": F.when(update & (F.col("_container") != ""), F.col("_container"))} if "container_id" in own else {}
    done = _guarded(counted, update, marks) if guard_terminal else _overwriting(counted, update, marks)
    out = done.result().withColumn("retry_count", F.least("_failures", limit))
    return out.select("job_id", *ORDER, *keep, *STATE, *own)


def _overwriting(rows: Ordered, update: Column, marks: dict[str, Column]) -> Ordered:
    """Every status update counts. A cancel request counts if it finds the job open."""
    still_open = ~F.col("_resting").isin(TERMINAL)
    # Of several requests in a row, the first closes the job.
    first = ~F.coalesce("_after_cancel", F.lit(False))
    completed = F.when(update, F.col("_completed")).when(still_open & first, F.col("ts"))
    status = F.when(~update & still_open, CANCELLED).otherwise(F.col("_resting"))
    return (
        rows.sliding(1, lambda d, w: d.withColumn("_after_cancel", F.lag("is_cancel", 1).over(w)))
        .running(lasts=_marks(update, completed) | marks)
        .map(lambda d: d.withColumn("status_after", status))
    )


def _guarded(rows: Ordered, update: Column, marks: dict[str, Column]) -> Ordered:
    """Nothing changes after the first event that leaves a final state."""
    after = F.when(update, F.col("_resting")).otherwise(CANCELLED)
    final = F.col("_after").isin(TERMINAL)
    rows = rows.map(lambda d: d.withColumn("_after", after)).running(sums={"_finals": F.when(final, 1).otherwise(0)})
    counts = (F.col("_finals") == 0) | ((F.col("_finals") == 1) & final)
    completed = F.when(counts, F.when(update, F.col("_completed")).otherwise(F.col("ts")))
    return (
        rows.map(lambda d: d.drop("_failures"))
        .running(
            sums={"_failures": F.when(counts, F.col("_failed")).otherwise(0)},
            lasts=_marks(update & counts, completed)
            | {n: F.when(counts, c) for n, c in marks.items()}
            | {"status_after": F.when(counts, F.col("_after"))},
        )
    )


def _marks(update: Column, completed: Column) -> dict[str, Column]:
    return {
        "started_at": F.when(update, F.col("_started")),
        "completed_at": completed,
        "last_error": F.when(update & (F.col("error_message") != ""), F.col("error_message")),
    }
