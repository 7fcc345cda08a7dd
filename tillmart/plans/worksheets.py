"""Dashboard queries over the flat sales table.

The flat table repeats a sale's total on each of its lines, and these queries sum
it at that grain, as the dashboard does. `total_sales_header_grain` counts it once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.functions.calendar import day_start
from tillmart.functions.measures import (
    CUSTOMERS,
    PRODUCT_COUNT,
    QUANTITY,
    TOTAL_SALES,
    TRANSACTIONS,
    UNIT_PRICES,
    Measure,
    caption,
    default_measure,
)
from tillmart.operators.days import Days, on_days
from tillmart.operators.positions import with_positions
from tillmart.schemas import WIDE_MONEY

KPI_ORDER: tuple[Measure, ...] = (QUANTITY, TOTAL_SALES, CUSTOMERS, TRANSACTIONS)
PERFORMANCE_ORDER: tuple[Measure, ...] = (TOTAL_SALES, QUANTITY, CUSTOMERS, TRANSACTIONS)


def kpis(sales_full: DataFrame) -> DataFrame:
    return sales_full.agg(*[measure.build() for measure in KPI_ORDER])


def kpis_long(
    sales_full: DataFrame, measures: tuple[Measure, ...] = KPI_ORDER
) -> DataFrame:
    """The chosen measures as rows of caption and value, in the given order."""
    wide = sales_full.agg(
        *[measure.build().cast(WIDE_MONEY).alias(measure.name) for measure in measures]
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(place).alias("position"),
                F.lit(measure.caption).alias("measure"),
                F.col(measure.name).alias("value"),
            )
            for place, measure in enumerate(measures, 1)
        ]
    )
    return wide.select(F.inline(cells)).orderBy("position")


def product_performance(sales_full: DataFrame) -> DataFrame:
    """Measures per product and source, best-selling product first.

    The product's own total, by which rows are ordered, is a window over the cells:
    a window group holds one row per source.
    """
    cells, order = _performance(sales_full)
    return cells.orderBy(*order).drop("_of_product")


def product_performance_positions(sales_full: DataFrame) -> DataFrame:
    """The same rows with their place in that order, as `position`."""
    cells, order = _performance(sales_full)
    return with_positions(cells, order).drop("_of_product")


def _performance(sales_full: DataFrame) -> tuple[DataFrame, list[Column]]:
    cells = sales_full.groupBy("product_name", "source").agg(
        *[measure.build() for measure in PERFORMANCE_ORDER]
    )
    of_product = F.sum(TOTAL_SALES.name).over(W.partitionBy("product_name"))
    order = [F.desc_nulls_last("_of_product"), F.asc("product_name"), F.asc("source")]
    return cells.withColumn("_of_product", of_product), order


def quantity_per_product(sales_full: DataFrame, collation: str | None = None) -> DataFrame:
    """Units per product, alphabetically; `collation` names a locale order."""
    name = F.col("product_name")
    order = F.collate(name, collation) if collation else name
    return sales_full.groupBy("product_name").agg(QUANTITY.build()).orderBy(order)


def sales_over_time(sales_full: DataFrame) -> DataFrame:
    """Sum of unit prices per day. The chart titles it a total amount; it is not
    multiplied by quantity there, nor here."""
    day = day_start(F.col("transaction_date")).alias("day")
    return sales_full.groupBy(day).agg(UNIT_PRICES.build()).orderBy("day")


def sales_by_source(sales_full: DataFrame) -> DataFrame:
    """Sales and units per source, with the source's share of all sales.

    The whole is summed over the slices, one row per source, not over the table.
    """
    slices = sales_full.groupBy("source").agg(TOTAL_SALES.build(), QUANTITY.build())
    whole = F.sum(TOTAL_SALES.name).over(W.partitionBy())
    share = F.col(TOTAL_SALES.name).cast("double") / whole.cast("double")
    return slices.withColumn("share", share)


def count_products(sales_full: DataFrame) -> DataFrame:
    return sales_full.agg(PRODUCT_COUNT.build())


def total_sales_header_grain(sales: DataFrame) -> DataFrame:
    """Total sales counted once per sale."""
    return sales.agg(TOTAL_SALES.build())


def default_measures(sales_full: DataFrame, date_column: str = "transaction_date") -> DataFrame:
    """Every field under its default aggregation, by the year of `date_column`."""
    year = default_measure(sales_full.schema[date_column])
    others = [
        default_measure(column)
        for column in sales_full.schema
        if not isinstance(column.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
    ]
    return sales_full.groupBy(year).agg(*others)


def captioned(sheet: DataFrame) -> DataFrame:
    """A sheet, or the flat table itself, under the names a viewer sees.

    Units are a plain field of the flat table but a named measure of a sheet.
    """
    names = {name: caption(name) for name in sheet.columns}
    if QUANTITY.name in names and "item_id" not in names:
        names[QUANTITY.name] = QUANTITY.caption
    return sheet.withColumnsRenamed(names)


def dashboard(sales_full: DataFrame, days: Days = None) -> dict[str, DataFrame]:
    """All sheets. Days selected on the trend filter the other four, not the trend."""
    chosen = on_days(sales_full, days)
    return {
        "KPIs": kpis(chosen),
        "Product Performance": product_performance(chosen),
        "Quantity Sold per Product": quantity_per_product(chosen),
        "Sales Trend": sales_over_time(sales_full),
        "Sales by Source": sales_by_source(chosen),
    }
