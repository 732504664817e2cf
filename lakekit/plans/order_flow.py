"""Orders: total price and value flag, drop pending ones, check, write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.quality import Rule, expect_min, expect_not_null, gate
from lakekit.operators.transforms import product, where_ne, with_flag, with_product
from lakekit.sources.sinks import write

# Fixed values.
HIGH_VALUE = 1000
PENDING = "pending"


def rules() -> list[Rule]:
    return [expect_not_null("item"), expect_min("total_price", 0)]


def prepare(df: DataFrame) -> DataFrame:
    """Filter first, so that later columns are computed for the kept rows only."""
    kept = where_ne(df, "status", PENDING)
    priced = with_product(kept, "quantity", "unit_price", "total_price")
    return with_flag(priced, product("quantity", "unit_price") > HIGH_VALUE, "is_high_value")


def order_flow(df: DataFrame, path: str | None = None) -> DataFrame:
    """The checked orders, written to `path` and read back from there when it is given."""
    checked = gate(prepare(df), rules())
    if path is None:
        return checked
    write(checked, path)
    return df.sparkSession.read.schema(checked.schema).parquet(path)
