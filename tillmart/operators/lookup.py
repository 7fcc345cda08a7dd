"""Rows of requested sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.schemas import HEADER_COLUMNS, LINE_COLUMNS

Requests = str | Sequence[str] | DataFrame


def only_requested(df: DataFrame, requests: Requests) -> DataFrame:
    """Keep the rows of the requested sales.

    One id or a list of ids becomes a predicate that reaches the scan. A DataFrame
    with a `transaction_id` column may be of any size and becomes a semi-join.
    """
    if isinstance(requests, DataFrame):
        return df.join(requests.select("transaction_id"), "transaction_id", "left_semi")
    if isinstance(requests, str):
        return df.filter(F.col("transaction_id") == requests)
    return df.filter(F.col("transaction_id").isin(list(requests)))


def header_lookup(sales: DataFrame, requests: Requests) -> DataFrame:
    return only_requested(sales, requests).select(*HEADER_COLUMNS)


def items_lookup(items: DataFrame, requests: Requests) -> DataFrame:
    """The four line columns, led by the sale they belong to."""
    return only_requested(items, requests).select("transaction_id", *LINE_COLUMNS)
