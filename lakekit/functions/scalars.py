"""Scalar column functions: numbers, names, paths, maps, arrays, JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Two-decimal amount held as an exact decimal, so sums do not depend on row order."""
    return _col(c).cast(MONEY)


def round2(c: Column | str) -> Column:
    """Half-up to two digits."""
    return F.round(_col(c), 2)


def attempt_name(job_id: Column | str, retry: Column | str) -> Column:
    """`spark-job-{first 8 of id}-r{retry}`."""
    return F.concat(
        F.lit("spark-job-"), F.substring(_col(job_id), 1, 8), F.lit("-r"), _col(retry).cast("string")
    )


def table_location(warehouse: str, db: Column | str, table: Column | str) -> Column:
    return F.concat_ws("/", F.lit(warehouse.rstrip("/")), _col(db), _col(table), F.lit(""))


def to_s3a(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "^s3://", "s3a://")


def map_merge(left: Column | str, right: Column | str) -> Column:
    """Union of two maps; the right one wins for equal keys."""
    left, right = _col(left), _col(right)
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)


def edit_fields(
    fields: Column | str,
    add: Column | str | None = None,
    drop: Column | str | None = None,
    rename: Column | str | None = None,
) -> Column:
    """Edit an array of field structs in the order add, drop, rename.

    `add` is an array of the same struct, `drop` an array of names, `rename` an array of
    (old, new) structs applied one after the other.
    """
    out = _col(fields)
    if add is not None:
        out = F.concat(out, _col(add))
    if drop is not None:
        gone = _col(drop)
        out = F.filter(out, lambda f: ~F.array_contains(gone, f["name"]))
    if rename is not None:
        out = F.aggregate(
            _col(rename),
            out,
            lambda acc, r: F.transform(
                acc,
                lambda f, i: F.when(
                    i + 1 == F.array_position(F.transform(acc, lambda g: g["name"]), r["old"]), f.withField("name", r["new"])
                ).otherwise(f),
            ),
        )
    return out


def change_texts(fields: Column | str, add: Column | str, drop: Column | str, rename: Column | str) -> Column:
    """One text for each change that `edit_fields` logs; a rename of a missing field is not logged."""
    add, drop, rename = _col(add), _col(drop), _col(rename)
    names = F.transform(edit_fields(fields, add, drop), lambda f: f["name"])
    start = F.struct(names.alias("names"), F.array().cast("array<string>").alias("texts"))

    def step(acc: Column, r: Column) -> Column:
        hit = F.array_contains(acc["names"], r["old"])
        text = F.concat(F.lit("Renamed column: "), r["old"], F.lit(" -> "), r["new"])
        return F.struct(
            F.transform(
                acc["names"], lambda n, i: F.when(i + 1 == F.array_position(acc["names"], r["old"]), r["new"]).otherwise(n)
            ).alias("names"),
            F.when(hit, F.concat(acc["texts"], F.array(text))).otherwise(acc["texts"]).alias("texts"),
        )

    return F.concat(
        F.transform(add, lambda f: F.concat(F.lit("Added column: "), f["name"], F.lit(" ("), f["type"], F.lit(")"))),
        F.transform(drop, lambda n: F.concat(F.lit("Dropped column: "), n)),
        F.aggregate(rename, start, step, lambda acc: acc["texts"]),
    )


def join_changes(c: Column | str) -> Column:
    return F.array_join(_col(c), "; ")


def json_field(c: Column | str, path: str, kind: str = "string") -> Column:
    """The value at a JSON path such as `$.a.b`; null when absent or not of the type."""
    return F.get_json_object(_col(c), path).try_cast(kind)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
