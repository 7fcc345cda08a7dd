"""Small invented sales."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tillmart.schemas import ITEMS, SALES

NESTED = (
    '{"transactionId":"N-1","customer_information":{"name":"Ann Lee","address":"1 Low St, Town",'
    '"age":29,"gender":"F","phone":"+6312345"},"line_items":[{"lineId":" N-1-1","product":'
    '"A \\"fine\\" book, vol. 2","unitPrice":499.00,"quantity":2},{"lineId":"N-1-2","product":"Map",'
    '"unitPrice":1.50,"quantity":1}],"total":999.50,"mop":"Card","timestamp":"2025-09-29T10:15:00+08:00"}'
)
FLAT = (
    '{"salesId":"F-1","fullName":"Bo Ray","deliveryLoc":"2 High St","contact":"0917","products":'
    '[{"id":"F-1-1","name":"Map","price":1.5,"qty":3}],"amountDue":4.50,"paymentType":"Cash",'
    '"creationDate":"2025-09-20T10:20:05.750Z"}'
)


def sale(
    key,
    source="A",
    name="Ann",
    address="Town",
    contact="+63",
    age=29,
    gender="F",
    total="10.00",
    payment="Cash",
    at=datetime(2025, 9, 20, 10, 20),
):
    amount = None if total is None else Decimal(total)
    return (key, source, name, address, contact, age, gender, amount, payment, at)


def line(item, key, product="Map", price="1.50", quantity=1):
    return (item, key, product, None if price is None else Decimal(price), quantity)


def tables(spark, sales, items):
    return spark.createDataFrame(sales, SALES), spark.createDataFrame(items, ITEMS)


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)
