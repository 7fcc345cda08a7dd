"""A cube of the flat sales table in which sums and exact distinct counts both add up.

Customers and transactions get dense numbers, and a cell of day, product and source holds the
numbers of its own as words of 64 bits. The members of several cells are the words joined by
`or`, so any choice of days, products and sources is counted exactly without the lines.
Transactions are numbered by source and day: those of a cell lie in few words.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmart.functions.calendar import day_start
from tillmart.functions.measures import CUSTOMERS, QUANTITY, TOTAL_SALES, TRANSACTIONS, UNIT_PRICES
from tillmart.operators.days import MONTH_COLUMN, Days, on_days, with_month
from tillmart.operators.positions import with_positions
from tillmart.schemas import WIDE_MONEY
from tillmart.sources.scratch import scratch_dir
from tillmart.sources.stores import Store

CELLS_TABLE = "dm_sales.sales_cube"
MEMBERS_TABLE = "dm_sales.sales_cube_members"
DIMENSIONS = ["transaction_date", "product_name", "source"]
LINE_VALUES = ["customer_name", "transaction_id", "quantity", "total_amount", "price"]
WORD_BITS = 64


def _numbered(values: DataFrame, column: str, order: Sequence[Column], name: str) -> DataFrame:
    placed = with_positions(values, order, "_place")
    return placed.select(F.col(column), (F.col("_place") - 1).alias(name))


def cube_rows(sales_full: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells, and the members of the cells, of a flat sales table.

    `transaction_date` of a cell is its day. Customers and transactions that are null are no
    members, as distinct counts leave them out.
    """
    day = day_start(F.col("transaction_date"))
    lines = sales_full.withColumn("transaction_date", day)
    cells = lines.groupBy(*DIMENSIONS).agg(
        F.sum("quantity").alias("quantity"),
        F.sum("total_amount").cast(WIDE_MONEY).alias("total_amount"),
        F.sum("price").cast(WIDE_MONEY).alias("price"),
    )
    customers = lines.select("customer_name").filter("customer_name IS NOT NULL").distinct()
    sold = lines.filter("transaction_id IS NOT NULL").groupBy("transaction_id")
    sales = sold.agg(F.min("source").alias("source"), F.min("transaction_date").alias("day"))
    by_day = [F.asc("source"), F.asc("day"), F.asc("transaction_id")]
    numbered = (
        lines.select(*DIMENSIONS, "customer_name", "transaction_id")
        .join(_numbered(customers, "customer_name", [F.asc("customer_name")], "_customer"), "customer_name", "left")
        .join(_numbered(sales, "transaction_id", by_day, "_transaction"), "transaction_id", "left")
    )
    kinds = [(CUSTOMERS.name, "_customer"), (TRANSACTIONS.name, "_transaction")]
    each = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("number")) for kind, c in kinds])
    told = numbered.select(*DIMENSIONS, F.inline(each)).filter("number IS NOT NULL")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("number") % WORD_BITS).cast("int"))
    word = F.floor(F.col("number") / WORD_BITS).cast("long").alias("word")
    members = told.groupBy(*DIMENSIONS, "kind", word).agg(F.bit_or(bit).alias("bits"))
    return cells, members


def write_cube(sales_full: DataFrame, store: Store) -> None:
    """Write the cube anew, both tables by month, so that a selection reads its months only.

    The lines are read four times: they are written to the shared folder first, so that what
    they are made of is worked out once.
    """
    spark = sales_full.sparkSession
    folder = f"{scratch_dir(spark, 'cube-lines')}/rows"
    lines = sales_full.select(*DIMENSIONS, *LINE_VALUES)
    lines.write.parquet(folder, compression="zstd")
    stored = spark.read.schema(lines.schema).parquet(folder)
    for table, rows in zip((CELLS_TABLE, MEMBERS_TABLE), cube_rows(stored)):
        store.write(with_month(rows), table, "overwrite", [MONTH_COLUMN])


@dataclass
class Cube:
    """The sheets of the dashboard from the cube; each takes the selected days."""

    cells: DataFrame
    members: DataFrame

    @classmethod
    def read(cls, store: Store) -> Cube:
        return cls(store.read(CELLS_TABLE), store.read(MEMBERS_TABLE))

    def measures(self, by: Sequence[str], days: Days = None) -> DataFrame:
        """Units, sales, and exact distinct customers and transactions by some dimensions."""
        sums = on_days(self.cells, days).groupBy(*by).agg(
            F.sum("quantity").alias(QUANTITY.name), F.sum("total_amount").alias(TOTAL_SALES.name)
        )
        words = on_days(self.members, days).groupBy(*by, "kind", "word").agg(F.bit_or("bits").alias("bits"))

        def count(kind: str) -> Column:
            return F.sum(F.when(F.col("kind") == kind, F.bit_count("bits").cast("long"))).alias(kind)

        counts = words.groupBy(*by).agg(count(CUSTOMERS.name), count(TRANSACTIONS.name))
        both = sums.unionByName(counts, allowMissingColumns=True)
        return both.groupBy(*by).agg(
            F.sum(QUANTITY.name).alias(QUANTITY.name),
            F.sum(TOTAL_SALES.name).cast(WIDE_MONEY).alias(TOTAL_SALES.name),
            F.coalesce(F.sum(CUSTOMERS.name), F.lit(0)).alias(CUSTOMERS.name),
            F.coalesce(F.sum(TRANSACTIONS.name), F.lit(0)).alias(TRANSACTIONS.name),
        )

    def kpis(self, days: Days = None) -> DataFrame:
        return self.measures([], days)

    def product_performance(self, days: Days = None) -> DataFrame:
        cells = self.measures(["product_name", "source"], days)
        of_product = F.sum(TOTAL_SALES.name).over(W.partitionBy("product_name"))
        names = ["product_name", "source", TOTAL_SALES.name, QUANTITY.name, CUSTOMERS.name, TRANSACTIONS.name]
        order = [F.desc_nulls_last("_of_product"), F.asc("product_name"), F.asc("source")]
        return cells.withColumn("_of_product", of_product).orderBy(*order).select(names)

    def quantity_per_product(self, days: Days = None) -> DataFrame:
        chosen = on_days(self.cells, days).groupBy("product_name")
        return chosen.agg(F.sum("quantity").alias(QUANTITY.name)).orderBy("product_name")

    def sales_over_time(self) -> DataFrame:
        by_day = self.cells.groupBy(F.col("transaction_date").alias("day"))
        return by_day.agg(F.sum("price").cast(WIDE_MONEY).alias(UNIT_PRICES.name)).orderBy("day")

    def sales_by_source(self, days: Days = None) -> DataFrame:
        slices = on_days(self.cells, days).groupBy("source").agg(
            F.sum("total_amount").cast(WIDE_MONEY).alias(TOTAL_SALES.name),
            F.sum("quantity").alias(QUANTITY.name),
        )
        # One row per source.
        whole = F.sum(TOTAL_SALES.name).over(W.partitionBy())
        return slices.withColumn("share", F.col(TOTAL_SALES.name).cast("double") / whole.cast("double"))

    def dashboard(self, days: Days = None) -> dict[str, DataFrame]:
        """All sheets, as `worksheets.dashboard` gives them from the lines."""
        return {
            "KPIs": self.kpis(days),
            "Product Performance": self.product_performance(days),
            "Quantity Sold per Product": self.quantity_per_product(days),
            "Sales Trend": self.sales_over_time(),
            "Sales by Source": self.sales_by_source(days),
        }
