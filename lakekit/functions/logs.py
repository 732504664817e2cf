"""Log-line functions: parsing, labels, nanosecond time, formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.scalars import _col

# The time format of a line and the label defaults.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DEFAULT_SOURCE = "unknown"
DEFAULT_LEVEL = "INFO"


def parse_log(df: DataFrame, line: str = "line") -> DataFrame:
    """Split `[ts] [level] message`; other lines keep their text as the message."""
    parts = F.split(line, r"\] \[|\] ", 3)
    stamp, level, message = (F.get(parts, i) for i in range(3))
    inside = r"^\[[^\]]+$"
    # "[ts] [level] message": brackets around the first two parts and nowhere else in them.
    hit = stamp.rlike(inside) & F.col(line).startswith(F.concat(stamp, F.lit("] ["), level, F.lit("] "))) & level.rlike(r"^[^\]]+$")
    stamp = F.substr(stamp, F.lit(2))
    hit = F.coalesce(hit & message.isNotNull(), F.lit(False))
    return df.withColumns(
        {
            "ts": F.try_to_timestamp(F.when(hit, stamp), F.lit(TIME_FORMAT)),
            "level": F.when(hit, level),
            "message": F.when(hit, message).otherwise(F.col(line)),
        }
    )


def add_labels(df: DataFrame, **labels: str | Column) -> DataFrame:
    """Attach label columns; `source` is `driver` unless given."""
    labels = {"source": "driver", **labels}
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in labels.items()})


def default_labels(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "source": F.coalesce("source", F.lit(DEFAULT_SOURCE)),
            "level": F.coalesce("level", F.lit(DEFAULT_LEVEL)),
        }
    )


def ns_to_ts(ns: Column | str) -> Column:
    """Nanoseconds since the epoch to a timestamp, cut to microseconds."""
    return F.timestamp_micros(F.call_function("div", _col(ns), F.lit(1000)))


def ts_to_ns(ts: Column | str) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp")) * 1000


def format_log(ts: Column | str, source: Column | str, message: Column | str) -> Column:
    """`[ts] [source] message` with an ISO time; whole seconds carry no fraction."""
    return F.format_string("[%s] [%s] %s", iso_time(ts), _col(source), _col(message))


def iso_time(ts: Column | str) -> Column:
    ts = _col(ts).cast("timestamp_ntz")
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", "").otherwise(fraction))
