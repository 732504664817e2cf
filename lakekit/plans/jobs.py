"""Complete batch jobs on generated tables: generate, compute, write.

    python -m lakekit.plans.jobs JOB --warehouse PATH [--records N] [--seed N]

Each job writes under its own name and returns the frame that a user looks at.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.operators.aggregates import dedup_report, distribution, pivot_sum, row_count, summarize
from lakekit.operators.joins import join_inner, join_summary
from lakekit.operators.paging import dedup
from lakekit.operators.transforms import selectivity, where_gt
from lakekit.operators.windows import moving_avg
from lakekit.plans.order_flow import order_flow
from lakekit.plans.sales_etl import sales_etl
from lakekit.session import build_session
from lakekit.sources import synth as s
from lakekit.sources.sinks import write

Job = Callable[[SparkSession, str, int, int], DataFrame]

# The columns of the generated tables and their domains.
COUNTRIES = ["US", "UK", "DE", "JP", "IN"]
TABLES: dict[str, dict[str, s.Kind]] = {
    "demo": {
        "id": s.sequence(),
        "random_int": s.uniform_int(1, 100),
        "random_double": s.uniform(0, 100, digits=None),
    },
    "sales": {
        "transaction_id": s.sequence(1),
        "amount": s.uniform(5, 500),
        "category": s.choice(["electronics", "clothing", "food", "home", "sports"]),
        "country": s.choice(COUNTRIES),
        "customer_id": s.prefixed_int("customer_", 1, 200),
    },
    "events": {
        "event_id": s.sequence(),
        "user_id": s.prefixed_int("user_", 1, 500),
        "event_type": s.choice(["click", "view", "purchase", "search"]),
        "value": s.uniform(0, 100),
    },
    "revenue": {
        "id": s.sequence(),
        "category": s.choice(["electronics", "clothing", "food", "home", "sports", "books"]),
        "revenue": s.uniform(10, 1000),
    },
    "transactions": {
        "id": s.sequence(),
        "txn_ref": s.padded("txn_"),
        "amount": s.uniform(1, 5000),
        "country": s.choice(COUNTRIES),
    },
    "sensors": {
        "id": s.sequence(),
        "sensor_id": s.prefixed_int("sensor_", 1, 10),
        "timestamp": s.hourly("2026-01-01"),
        "temperature": s.uniform(15, 45),
    },
    "customers": {
        "customer_id": s.sequence(1),
        "name": lambda row, seed, name: F.concat(F.lit("customer_"), (row + 1).cast("string")),
        "tier": s.choice(["gold", "silver", "bronze"]),
        "country": s.choice(["US", "UK", "DE", "JP"]),
    },
    "orders": {
        "order_id": s.sequence(),
        "customer_id": s.uniform_int(1, 200),
        "total": s.uniform(10, 2000),
    },
    "emails": {
        "id": s.sequence(),
        "email": s.modular("email_", 300, "@test.com"),
        "score": s.uniform(1, 100),
    },
    "product_sales": {
        "id": s.sequence(),
        "region": s.choice(["north", "south", "east", "west"]),
        "product": s.choice(["widget_a", "widget_b", "widget_c", "widget_d"]),
        "month": s.choice(["2026-01", "2026-02", "2026-03"]),
        "sales": s.uniform(100, 10000),
    },
    "measurements": {
        "id": s.sequence(),
        "measurement": s.gauss(100, 25),
        "group": s.choice(["A", "B", "C"]),
    },
    "partitioned_sales": {
        "id": s.sequence(),
        "country": s.choice([*COUNTRIES, "BR"]),
        "year": s.choice(["2024", "2025", "2026"]),
        "product": s.prefixed_int("product_", 1, 50),
        "amount": s.uniform(5, 500),
    },
    "item_orders": {
        "order_id": s.sequence(),
        "item": s.prefixed_int("item_", 1, 100),
        "quantity": s.uniform_int(1, 50),
        "unit_price": s.uniform(5, 200),
        "status": s.choice(["pending", "shipped", "delivered"]),
    },
}
CUSTOMERS = 200


def generate(spark: SparkSession, table: str, records: int, seed: int = 0) -> DataFrame:
    return s.synth(spark, records, TABLES[table], seed)


def demo(spark: SparkSession, out: str, records: int, seed: int) -> DataFrame:
    return generate(spark, "demo", records, seed)


def load_sales(spark: SparkSession, out: str, records: int, seed: int, date: str = "2026-03-28", mode: str = "append") -> DataFrame:
    return sales_etl(generate(spark, "sales", records, seed), out, date, mode)


def user_events(spark: SparkSession, out: str, records: int, seed: int) -> DataFrame:
    events = generate(spark, "events", records, seed)
    write(events, out)
    return row_count(events)


def category_revenue(spark: SparkSession, out: str, records: int, seed: int) -> DataFrame:
    totals = summarize(generate(spark, "revenue", records, seed), ["category"], "revenue")
    write(totals, out)
    return totals


def high_value(spark: SparkSession, out: str, records: int, seed: int) -> DataFrame:
    rows = generate(spark, "transactions", records, seed)
    write(where_gt(rows, "amount", 1000), out)
    return selectivity(rows, F.col("amount") > 1000)


def sensor_average(spark: SparkSession, out: str, records: int, seed: int) -> DataFrame:
    averaged = moving_avg(generate(spark, "sensors", records, seed), "sensor_id", ["timestamp", "id"], "temperature")
    write(averaged, out)
    return averaged


def customer_revenue(spark: SparkSession, out: str, records: int, seed: int) -> DataFrame:
    customers = generate(spark, "customers", CUSTOMERS, seed)
    orders = generate(spark, "orders", records, seed)
    write(join_inner(orders, customers, "customer_id"), out)
    return join_summary(orders, customers, "customer_id", ["tier", "country"], "total")


def unique_emails(spark: SparkSession, out: str, records: int, seed: int) -> DataFrame:
    rows = generate(spark, "emails", records, seed)
    write(dedup(rows, ["email"], ["id"]), out)
    return dedup_report(rows, ["email"])


def sales_by_month(spark: SparkSession, out: str, records: int, seed: int) -> DataFrame:
    rows = generate(spark, "product_sales", records, seed)
    table = pivot_sum(rows, "region", "month", "sales", ["2026-01", "2026-02", "2026-03"])
    write(table, out)
    return table


def measurement_stats(spark: SparkSession, out: str, records: int, seed: int) -> DataFrame:
    stats = distribution(generate(spark, "measurements", records, seed), "group", "measurement")
    write(stats, out)
    return stats


def sales_by_country(spark: SparkSession, out: str, records: int, seed: int) -> DataFrame:
    rows = generate(spark, "partitioned_sales", records, seed)
    write(rows, out, partition_by=["country", "year"])
    return row_count(rows)


def checked_orders(spark: SparkSession, out: str, records: int, seed: int) -> DataFrame:
    return order_flow(generate(spark, "item_orders", records, seed), out)


JOBS: dict[str, Job] = {
    job.__name__: job
    for job in (
        demo, load_sales, user_events, category_revenue, high_value, sensor_average, customer_revenue,
        unique_emails, sales_by_month, measurement_stats, sales_by_country, checked_orders,
    )
}


def run_job(spark: SparkSession, name: str, warehouse: str, records: int = 1000, seed: int = 0, **options) -> DataFrame:
    return JOBS[name](spark, f"{warehouse.rstrip('/')}/{name}", records, seed, **options)


def main() -> None:
    parser = argparse.ArgumentParser(description="Run a batch job on generated data")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--records", type=int, default=1000)
    parser.add_argument("--seed", type=int, default=0)
    parser.add_argument("--date", help="load_sales only: the day to load")
    parser.add_argument("--mode", choices=["append", "overwrite"], help="load_sales only")
    args = parser.parse_args()
    options = {k: v for k, v in (("date", args.date), ("mode", args.mode)) if v}
    spark = build_session(args.job)
    run_job(spark, args.job, args.warehouse, args.records, args.seed, **options).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
