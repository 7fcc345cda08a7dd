"""Datamarts over the staged sales tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmart.functions.calendar import age_band, month_start
from tillmart.functions.masking import mask_columns
from tillmart.operators.days import MONTH_COLUMN, with_month
from tillmart.operators.lines import sale_lines, sold_by_product
from tillmart.operators.positions import with_positions
from tillmart.plans.audit import DONE, FAILED, Run, counted_write, now, stamped, summary
from tillmart.schemas import WIDE_MONEY
from tillmart.sources.scratch import passing_shuffles, scratch_dir
from tillmart.sources.stores import Store

STAMP_COLUMN = "load_timestamp"

# Which personal fields are masked, and how.
PERSONAL_FIELDS = {
    "customer_name": "hash",
    "delivery_address": "fixed",
    "customer_contact": "partial",
}


def _money(column: str) -> Column:
    return F.sum(column).cast(WIDE_MONEY)


def top_selling_products(sales: DataFrame, items: DataFrame) -> DataFrame:
    return sold_by_product(sales, items)


def sales_by_source(sales: DataFrame, items: DataFrame) -> DataFrame:
    return sales.groupBy("source").agg(
        _money("total_amount").alias("total_sales"),
        F.count("transaction_id").alias("transactions"),
    )


def customer_demographics(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Groups are formed on the clear values; masking comes after and merges none."""
    who = ["customer_name", "delivery_address", "customer_contact"]
    return (
        sales.withColumn("age_group", age_band(F.col("customer_age")))
        .groupBy("customer_gender", "age_group", *who)
        .agg(
            F.count(F.lit(1)).alias("count_customers"),
            _money("total_amount").alias("total_spent"),
        )
        .select("customer_gender", "age_group", "count_customers", "total_spent", *who)
    )


def sales_trend(sales: DataFrame, items: DataFrame) -> DataFrame:
    return sales.groupBy(month_start(F.col("transaction_date")).alias("month")).agg(
        _money("total_amount").alias("monthly_sales")
    )


def sales_full(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Line-grain table with masked customers.

    Customers are masked on the header, before the join repeats it per line, so a
    name is hashed once per sale and no clear value is shuffled.
    """
    return sale_lines(mask_columns(sales, PERSONAL_FIELDS), items)


@dataclass(frozen=True)
class Mart:
    """A target table with either a builder over the staged tables or SQL text.

    `order` is how the rows are presented by `read_mart`; a stored table has none.
    """

    target_table: str
    build: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    sql: str | None = None
    mask_columns: Mapping[str, str] = field(default_factory=dict)
    order: Callable[[], list[Column]] | None = None
    by_month: bool = False

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> Mart:
        """Read one entry of the JSON datamart configuration."""
        return cls(
            target_table=raw["target_table"],
            sql=raw["sql"],
            mask_columns=dict(raw.get("mask_columns") or {}),
        )


TOP_SELLING_PRODUCTS = Mart(
    "dm_sales.top_selling_products",
    top_selling_products,
    order=lambda: [F.desc_nulls_first("total_sold"), F.asc("product_name")],
)
SALES_BY_SOURCE = Mart("dm_sales.sales_by_source", sales_by_source)
CUSTOMER_DEMOGRAPHICS = Mart(
    "dm_sales.customer_demographics", customer_demographics, mask_columns=PERSONAL_FIELDS
)
SALES_TREND = Mart(
    "dm_sales.sales_trend", sales_trend, order=lambda: [F.asc_nulls_last("month")]
)
SALES_FULL = Mart("dm_sales.sales_full", sales_full)
MARTS = [TOP_SELLING_PRODUCTS, SALES_BY_SOURCE, CUSTOMER_DEMOGRAPHICS, SALES_TREND, SALES_FULL]


def mart_rows(mart: Mart, sales: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of a built mart, masked and ordered, without the audit column."""
    rows = mask_columns(mart.build(sales, items), mart.mask_columns)
    return rows.orderBy(*mart.order()) if mart.order else rows


def read_mart(store: Store, mart: Mart) -> DataFrame:
    rows = store.read(mart.target_table)
    return rows.orderBy(*mart.order()) if mart.order else rows


def mart_positions(mart: Mart, sales: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of a built mart with their place in its order, as `position`."""
    if mart.order is None:
        raise ValueError(f"{mart.target_table} has no order")
    return with_positions(mask_columns(mart.build(sales, items), mart.mask_columns), mart.order())


def top_products(sales: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The k products sold most, best first; ties go by name. Each task keeps k rows."""
    return top_selling_products(sales, items).orderBy(*TOP_SELLING_PRODUCTS.order()).limit(k)


def top_products_by_source(sales: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """source, product_name, total_sold, rank: the k products sold most through each source.

    Tasks drop what is beyond the k best of a source before rows are shuffled by source.
    """
    lines = items.select("transaction_id", "product_name", "quantity")
    sold = (
        lines.join(sales.select("transaction_id", "source"), "transaction_id")
        .groupBy("source", "product_name")
        .agg(F.sum("quantity").alias("total_sold"))
    )
    best = Window.partitionBy("source").orderBy(*TOP_SELLING_PRODUCTS.order())
    return sold.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


# The marts over headers alone, and what they are grouped by.
HEADER_GROUPS = {
    "dm_sales.sales_by_source": ["source"],
    "dm_sales.customer_demographics": [
        "customer_gender", "age_group", "customer_name", "delivery_address", "customer_contact",
    ],
    "dm_sales.sales_trend": ["month"],
}


def header_groups(sales: DataFrame) -> DataFrame:
    """The groups of all marts over headers, from one scan; `grouping` tells whose they are."""
    columns = [c for group in HEADER_GROUPS.values() for c in group]
    keyed = sales.withColumns(
        {
            "age_group": age_band(F.col("customer_age")),
            "month": month_start(F.col("transaction_date")),
        }
    )
    grouped = keyed.groupingSets(list(HEADER_GROUPS.values()), *columns).agg(
        F.grouping_id().cast("int").alias("grouping"),
        F.count(F.lit(1)).alias("headers"),
        F.count("transaction_id").alias("transactions"),
        _money("total_amount").alias("total"),
    )
    return grouped


def _grouping(table: str) -> int:
    """The number Spark gives a grouping set: one bit for each column that is not in it."""
    columns = [c for group in HEADER_GROUPS.values() for c in group]
    bits = ["0" if c in HEADER_GROUPS[table] else "1" for c in columns]
    return int("".join(bits), 2)


def header_marts(groups: DataFrame) -> dict[str, DataFrame]:
    """The marts over headers, from their stored groups."""
    count, total = F.col("headers"), F.col("total")
    who = HEADER_GROUPS["dm_sales.customer_demographics"][2:]

    def of(table: str) -> DataFrame:
        return groups.filter(F.col("grouping") == _grouping(table))

    return {
        "dm_sales.sales_by_source": of("dm_sales.sales_by_source").select(
            "source", total.alias("total_sales"), "transactions"
        ),
        "dm_sales.customer_demographics": of("dm_sales.customer_demographics").select(
            "customer_gender", "age_group", count.alias("count_customers"),
            total.alias("total_spent"), *who,
        ),
        "dm_sales.sales_trend": of("dm_sales.sales_trend").select("month", total.alias("monthly_sales")),
    }


def stored_header_groups(sales: DataFrame) -> DataFrame:
    """The groups written once to the shared folder, a part for each mart."""
    folder = f"{scratch_dir(sales.sparkSession, 'header-groups')}/rows"
    header_groups(sales).write.partitionBy("grouping").parquet(folder)
    return sales.sparkSession.read.parquet(folder)


def with_one_header_scan(marts: Iterable[Mart], staging: Store, sales_table: str) -> list[Mart]:
    """The marts, those over headers alone built from groups of one scan of the headers.

    They are worth it if there are two of them at least. Marts of SQL text, or with a builder of
    their own, stay as they are.
    """
    listed = list(marts)
    built_in = {mart.target_table: mart.build for mart in MARTS}
    shared = [
        m for m in listed
        if m.target_table in HEADER_GROUPS and m.sql is None and m.build is built_in[m.target_table]
    ]
    if len(shared) < 2:
        return listed
    rows = header_marts(stored_header_groups(staging.read(sales_table)))
    return [
        replace(m, build=lambda sales, items, table=m.target_table: rows[table]) if m in shared else m
        for m in listed
    ]


def write_mart(
    staging: Store, target: Store, mart: Mart, run: Run, sales_table: str, items_table: str
) -> int:
    if mart.sql is not None:
        rows = staging.query(mart.sql)
    else:
        rows = mart.build(staging.read(sales_table), staging.read(items_table))
    rows = stamped(mask_columns(rows, mart.mask_columns), STAMP_COLUMN, run.stamp)
    partition_by = ()
    if mart.by_month:
        rows, partition_by = with_month(rows), (MONTH_COLUMN,)
    return counted_write(
        lambda seen: target.write(rows, mart.target_table, "overwrite", partition_by, seen)
    )


def run_datamarts(
    spark: SparkSession,
    staging: Store,
    target: Store,
    marts: Iterable[Mart] = tuple(MARTS),
    sales_table: str = "sales_transactions.sales",
    items_table: str = "sales_transactions.sales_items",
    audit: tuple[Store, str] | None = None,
    at_once: int = 8,
    one_header_scan: bool = False,
) -> DataFrame:
    """Write every mart anew, `at_once` of them at a time, and return the audit rows.

    A mart that fails is recorded, and the others go on. `one_header_scan` builds all marts
    over headers alone from a single scan of them. Shuffle files of a mart go when it is written.
    """
    run = Run(spark, "datamart")
    listed = list(marts)
    by_table = {mart.target_table: mart for mart in listed}
    if len(by_table) < len(listed):
        names = [mart.target_table for mart in listed]
        doubled = sorted({name for name in names if names.count(name) > 1})
        raise ValueError(f"several marts would write {', '.join(doubled)}")
    if one_header_scan:
        shared = with_one_header_scan(listed, staging, sales_table)
        by_table = {mart.target_table: mart for mart in shared}

    def build(table: str) -> None:
        started = now()
        try:
            written = write_mart(staging, target, by_table[table], run, sales_table, items_table)
            run.record(table, DONE, started, rows_out=written)
        except Exception as error:
            run.record(table, FAILED, started, message=summary(error))

    with passing_shuffles(spark):
        run.each(build, list(by_table), at_once)
    if audit and run.rows:
        run.save(*audit)
    return run.frame()
