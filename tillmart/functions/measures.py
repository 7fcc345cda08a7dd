"""Named measures of the flat sales table, usable in any groupBy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.schemas import WIDE_MONEY


@dataclass(frozen=True)
class Measure:
    name: str
    caption: str
    kind: str
    column: str

    def build(self) -> Column:
        source = F.col(self.column)
        if self.kind == "count":
            value = F.count(source)
        elif self.kind == "distinct":
            value = F.count_distinct(source)
        elif self.kind == "money":
            value = F.sum(source).cast(WIDE_MONEY)
        else:
            value = F.sum(source)
        return value.alias(self.name)


QUANTITY = Measure("quantity", "# of Items", "sum", "quantity")
TOTAL_SALES = Measure("total_sales", "Total Sales", "money", "total_amount")
CUSTOMERS = Measure("customers", "# of Customers", "distinct", "customer_name")
TRANSACTIONS = Measure("transactions", "# of Transactions", "distinct", "transaction_id")
PRODUCT_COUNT = Measure("count_products", "Count of Products", "count", "item_id")
UNIT_PRICES = Measure("total_price", "Total Amount", "money", "price")


CAPTIONS = {
    measure.name: measure.caption
    for measure in (TOTAL_SALES, CUSTOMERS, TRANSACTIONS, PRODUCT_COUNT, UNIT_PRICES)
}


def caption(name: str) -> str:
    """How the dashboard writes a measure or a field: fields in capitalized words."""
    return CAPTIONS.get(name) or name.replace("_", " ").title()


def default_measure(field: T.StructField) -> Column:
    """Aggregate a field gets when nobody chose one: text counts, numbers add up.

    Date-times become their year, which is a dimension and not an aggregate.
    """
    source = F.col(field.name)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.year(source).alias(f"year_{field.name}")
    if isinstance(field.dataType, T.DecimalType):
        return F.sum(source).cast(WIDE_MONEY).alias(f"sum_{field.name}")
    if isinstance(field.dataType, T.NumericType):
        return F.sum(source).alias(f"sum_{field.name}")
    return F.count(source).alias(f"count_{field.name}")
