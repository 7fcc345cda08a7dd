"""Joins of sale headers with their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.schemas import HEADER_COLUMNS, LINE_COLUMNS, SALES_FULL_COLUMNS, WIDE_MONEY


def sale_lines(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Header columns repeated on every line; unmatched rows of either side drop out.

    A plain equi-join straight over the two inputs: a bucketed pair needs no
    shuffle, a small side is broadcast by its measured size, and adaptive execution
    splits a sale that holds much of the lines.
    """
    headers = sales.select(*HEADER_COLUMNS)
    lines = items.select("transaction_id", *LINE_COLUMNS)
    return headers.join(lines, "transaction_id").select(*SALES_FULL_COLUMNS)


def sold_by_product(
    sales: DataFrame, items: DataFrame, unique_headers: bool = False
) -> DataFrame:
    """Units and revenue per product over the lines whose sale exists.

    A sale whose header occurs n times counts its lines n times. Headers are therefore
    reduced to their number of copies before they meet the lines, which are shuffled once:
    no pair of copies is ever formed, and adaptive execution splits a sale that holds much
    of the lines.

    `unique_headers` declares that a header occurs once; the join is then an
    existence check.
    """
    revenue = F.col("price") * F.col("quantity")
    if unique_headers:
        sold = items.join(sales.select("transaction_id"), "transaction_id", "left_semi")
        totals = sold.groupBy("product_name").agg(
            F.sum("quantity").alias("total_sold"), F.sum(revenue).alias("total_revenue")
        )
    else:
        copies = sales.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("copies"))
        lines = items.select("transaction_id", "product_name", "price", "quantity")
        totals = (
            lines.join(copies, "transaction_id")
            .groupBy("product_name")
            .agg(
                F.sum(F.col("quantity") * F.col("copies")).alias("total_sold"),
                F.sum(revenue * F.col("copies")).alias("total_revenue"),
            )
        )
    return totals.select(
        "product_name", "total_sold", F.col("total_revenue").cast(WIDE_MONEY).alias("total_revenue")
    )
