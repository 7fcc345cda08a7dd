"""Nested sale documents from header and line tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.functions.calendar import iso_text
from tillmart.operators.lookup import Requests, only_requested
from tillmart.schemas import HEADER_COLUMNS, LINE_COLUMNS

# The names and the order of the document's fields.
API_NAMES = {
    "transaction_id": "transactionId",
    "source": "source",
    "customer_name": "customerName",
    "delivery_address": "deliveryAddress",
    "customer_age": "customerAge",
    "customer_gender": "customerGender",
    "customer_contact": "customerContact",
    "items": "items",
    "total_amount": "totalAmount",
    "payment_type": "paymentType",
    "transaction_date": "transactionDate",
}


def _item() -> Column:
    return F.struct(
        F.col("item_id").alias("itemId"),
        F.col("product_name").alias("name"),
        F.col("price"),
        F.col("quantity"),
    )


def line_part(parts: int) -> Column:
    """The part of its sale that a line belongs to, by the line's content alone."""
    text = F.concat_ws(
        "|", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in LINE_COLUMNS]
    )
    digits = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.pmod(digits, F.lit(parts)).cast("int")


def item_arrays(items: DataFrame, parts: int = 1) -> DataFrame:
    """`transaction_id, part, items`: the lines of each sale in ordered arrays.

    Every sale's lines are dealt to the same number of parts, so that sales with very many
    lines stay small rows; one part gives each sale one array. Lines without a sale are left
    out, and so are parts without lines.
    """
    named = items.filter(F.col("transaction_id").isNotNull())
    arrays = F.sort_array(F.collect_list(_item())).alias("items")
    if parts == 1:
        # Grouped by the sale alone, the arrays lie as a join with headers needs them.
        whole = named.groupBy("transaction_id").agg(arrays)
        return whole.select("transaction_id", F.lit(0).alias("part"), "items")
    return named.withColumn("part", line_part(parts)).groupBy("transaction_id", "part").agg(arrays)


def _first_header(sales: DataFrame) -> DataFrame:
    """One header per sale; of several, always the same one."""
    rest = [name for name in HEADER_COLUMNS if name != "transaction_id"]
    kept = sales.groupBy("transaction_id").agg(F.min(F.struct(*rest)).alias("header"))
    return kept.select("transaction_id", *[F.col(f"header.{name}") for name in rest])


def sale_documents(sales: DataFrame, items: DataFrame, parts: int = 1) -> DataFrame:
    """Every sale as a nested document; a sale without lines has an empty array.

    With several `parts` a sale has a document for each part that holds lines of it, and each
    repeats the header.
    """
    arrays = item_arrays(items, parts)
    joined = _first_header(sales).join(arrays, "transaction_id", "left")
    return _document_columns(joined)


def requested_documents(
    sales: DataFrame,
    items: DataFrame,
    requests: DataFrame,
    parts: int = 1,
) -> DataFrame:
    """One document per requested id, led by that id.

    An id without a header gives a document whose header fields are all null.
    """
    wanted = requests.select("transaction_id").distinct()
    headers = _first_header(only_requested(sales, wanted)).withColumnRenamed("transaction_id", "found")
    arrays = item_arrays(only_requested(items, wanted), parts)
    joined = (
        wanted.withColumnRenamed("transaction_id", "requested_id")
        .join(headers, F.col("requested_id") == F.col("found"), "left")
        .join(
            arrays.withColumnRenamed("transaction_id", "line_sale"),
            F.col("requested_id") == F.col("line_sale"),
            "left",
        )
        .withColumnRenamed("found", "transaction_id")
    )
    return _document_columns(joined, "requested_id")


def _document_columns(joined: DataFrame, *leading: str) -> DataFrame:
    no_items = F.array().cast(joined.schema["items"].dataType)
    return joined.select(
        *leading,
        *[
            F.coalesce("items", no_items).alias("items")
            if name == "items"
            else F.col(name).alias(api_name)
            for name, api_name in API_NAMES.items()
        ],
        F.coalesce("part", F.lit(0)).alias("part"),
    )


def document_json(documents: DataFrame) -> Column:
    """The document as JSON text: fields in order, nulls printed."""
    fields = [
        iso_text(F.col(name)).alias(name) if name == "transactionDate" else F.col(name)
        for name in API_NAMES.values()
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
