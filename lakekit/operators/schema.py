"""Declared schemas, schema evolution and its history."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.functions.scalars import MONEY, change_texts, edit_fields, join_changes
from lakekit.operators.ordered import Ordered, default_run_rows
from lakekit.session import materialize

# The type names a declared schema may use.
TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "decimal": MONEY,
    "binary": T.BinaryType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    description: str | None = None


def spark_type(name: str) -> T.DataType:
    """The Spark type for a declared type name; `decimal(p,s)` is allowed as well."""
    sized = re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", name)
    if sized:
        return T.DecimalType(int(sized[1]), int(sized[2]))
    if name not in TYPES:
        raise ValueError(f"unknown type: {name}")
    return TYPES[name]


def _some(kind: T.DataType) -> Column:
    """Any value of a type that Spark knows not to be null."""
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(0))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_seconds(F.lit(0))
    if isinstance(kind, T.DecimalType):
        return F.lit(Decimal(0).scaleb(-kind.scale)).cast(kind)
    plain = {T.StringType: "", T.BinaryType: bytearray(), T.BooleanType: False}
    return F.lit(plain.get(type(kind), 0)).cast(kind)


def apply_schema(df: DataFrame, fields: list[Field]) -> DataFrame:
    """Cast to a declared schema. A null in a required column fails the query that reads it."""
    if not fields:
        raise ValueError("a schema needs at least one field")
    columns = []
    for f in fields:
        value = F.col(f.name).cast(spark_type(f.type))
        if not f.nullable:
            kind = spark_type(f.type)
            # The last value is never reached; it makes the result's column not nullable.
            value = F.coalesce(value, F.raise_error(F.lit(f"null in required column {f.name}")).cast(kind), _some(kind))
        metadata = {"comment": f.description} if f.description else {}
        columns.append(value.alias(f.name, metadata=metadata))
    return df.select(*columns)


def evolve(
    df: DataFrame,
    add: list[Field] = (),
    drop: list[str] = (),
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Add columns (null), then drop, then rename; missing columns are left out of the last two."""
    plan = [(name, F.col(name)) for name in df.columns]
    plan += [(f.name, F.lit(None).cast(spark_type(f.type))) for f in add]
    plan = [(name, value) for name, value in plan if name not in drop]
    for old, new in (rename or {}).items():
        plan = [(new if name == old else name, value) for name, value in plan]
    names = [name for name, _ in plan]
    if len(set(names)) < len(names):
        raise ValueError(f"duplicate column after the change: {names}")
    return df.select(*[value.alias(name) for name, value in plan])


def history(
    changes: DataFrame,
    table: str,
    order: list[str],
    first_version: int = 2,
    run_rows: int | None = None,
) -> DataFrame:
    """One row for each change that altered the schema: its version, fields and summary.

    `changes` rows carry `fields` (before the change), `add`, `drop`, `rename` and `changed_by`.
    Creation is version 1, so changes count from 2. Rows without a logged change get no version.
    """
    names = F.transform(F.concat("fields", "add"), lambda f: f["name"])
    kept = F.array_except(names, "drop")
    logged = (F.size("add") > 0) | (F.size("drop") > 0) | F.exists("rename", lambda r: F.array_contains(kept, r["old"]))
    numbered = Ordered(changes.filter(logged), [table], order, run_rows).running(sums={"_nth": F.lit(1)}).result()
    return numbered.select(
        table,
        *order,
        (F.col("_nth") + (first_version - 1)).alias("version"),
        edit_fields("fields", "add", "drop", "rename").alias("fields"),
        join_changes(change_texts("fields", "add", "drop", "rename")).alias("change_summary"),
        "changed_by",
    )


FIELD = "struct<name:string,type:string,nullable:boolean,description:string>"
FOLD_ROWS = 100_000  # changes of one table that a task folds at a time


def change_fields(fields: list[dict], change: dict) -> tuple[list[dict], list[str]]:
    """The fields after one change, and a text for each part of it that is logged. Added names may repeat: a drop
    takes all fields of a name, a rename the first one, if there is one."""
    texts = []
    for f in change["add"] or []:
        fields = [*fields, f]
        texts.append(f"Added column: {f['name']} ({f['type']})")
    for name in change["drop"] or []:
        fields = [f for f in fields if f["name"] != name]
        texts.append(f"Dropped column: {name}")
    for r in change["rename"] or []:
        at = next((i for i, f in enumerate(fields) if f["name"] == r["old"]), None)
        if at is not None:
            fields = [*fields[:at], {**fields[at], "name": r["new"]}, *fields[at + 1 :]]
            texts.append(f"Renamed column: {r['old']} -> {r['new']}")
    return fields, texts


def fold_changes(changes: Iterable[dict], fields: list[dict], version: int):
    """(change, version, fields, summary) of each logged change in turn, then (None, version, fields, None): where the table is."""
    for change in changes:
        fields, texts = change_fields(fields, change)
        if texts:
            version += 1
            yield change, version, fields, "; ".join(texts)
    yield None, version, fields, None


def accumulate(changes: DataFrame, table: str, order: list[str], start: list[Field], run_rows: int | None = None) -> DataFrame:
    """One row for each change that altered its table's schema: version, all fields from then on, summary, changed_by.

    Tables begin as version 1 with the `start` fields, and each change (`add`, `drop`, `rename`, in this order; nulls count as
    empty) applies to what the changes before it left, so whether a rename finds its field depends on all of them. Changes go
    by `order`, nulls first, ties in the order of the input. A change of which nothing is logged gets no version.

    A table's changes are folded in one task up to `run_rows`; a table with more is folded run after run, with the
    fields and version carried over, so no task holds more than a run, whatever one table's share.
    """
    limit = run_rows or min(default_run_rows(changes), FOLD_ROWS)
    kept = changes.select(table, *order, "add", "drop", "rename", "changed_by")
    ordered = Ordered(kept, [table], order, limit)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    keys = ", ".join(f"`{c}` {kinds[c]}" for c in (table, *order))
    out = f"{keys}, version long, fields array<{FIELD}>, change_summary string, changed_by string, _state boolean"
    spark = changes.sparkSession
    nothing = spark.createDataFrame([], out)
    arrow = nothing.toArrow().schema
    begin, by = [asdict(f) for f in start], [*order, "_tie"]
    names = [table, *order]

    def rows(changes: pa.Table, state: dict, with_state: bool) -> pa.Table:
        at = pc.sort_indices(changes, sort_keys=[(c, "ascending") for c in by], null_placement="at_start")
        found = []
        for change, version, fields, summary in fold_changes(changes.take(at).to_pylist(), state["fields"], state["version"]):
            if change or with_state:
                own = {c: change[c] for c in names} if change else {table: state[table]}
                by_whom = change["changed_by"] if change else None
                found.append(own | {"version": version, "fields": fields, "change_summary": summary, "changed_by": by_whom, "_state": change is None})
        return pa.Table.from_pylist(found, schema=arrow)


    def whole(key, changes):
        return rows(changes, {table: key[0].as_py(), "fields": begin, "version": 1}, False)

    def one_run(key, changes, before):
        state = before.to_pylist()[0] if before.num_rows else {table: key[0].as_py(), "fields": begin, "version": 1}
        return rows(changes, state, True)

    parts = [] if ordered.cold is None else [ordered.cold.groupBy(table).applyInArrow(whole, out)]
    state = nothing
    for run in range(ordered.runs):
        now = ordered.hot.where(F.col("_run") == run).drop("_run", "_key")
        step = now.groupBy(table).cogroup(state.select(table, "fields", "version").groupBy(table)).applyInArrow(one_run, out)
        step = materialize(step, "history")
        state = step.where("_state")
        parts.append(step.where("not _state"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.drop("_state")
