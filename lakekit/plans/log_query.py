"""A whole log request: labels, time range, the newest lines, default labels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from lakekit.functions.logs import default_labels
from lakekit.operators.paging import tail
from lakekit.operators.transforms import in_range, match_labels


def query_logs(
    logs: DataFrame,
    job_id: str,
    source: str = "all",
    n: int = 500,
    start: datetime | None = None,
    end: datetime | None = None,
    ties: list[str] = (),
) -> DataFrame:
    """The `n` newest lines of a job, newest first; labels and times are filtered in the scan, below the top-n."""
    picked = in_range(match_labels(logs, source, job_id=job_id), "ts", start, end)
    return default_labels(tail(picked, "ts", n, ties))
