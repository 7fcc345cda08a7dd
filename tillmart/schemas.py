"""Column lists and schemas shared by all jobs."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
WIDE_MONEY = T.DecimalType(38, 2)

SALES = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("delivery_address", T.StringType()),
        T.StructField("customer_contact", T.StringType()),
        T.StructField("customer_age", T.IntegerType()),
        T.StructField("customer_gender", T.StringType()),
        T.StructField("total_amount", MONEY),
        T.StructField("payment_type", T.StringType()),
        T.StructField("transaction_date", T.TimestampNTZType()),
    ]
)

ITEMS = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("quantity", T.IntegerType()),
    ]
)

HEADER_COLUMNS = SALES.names
LINE_COLUMNS = ["item_id", "product_name", "price", "quantity"]
SALES_FULL_COLUMNS = HEADER_COLUMNS + LINE_COLUMNS

# Numbers as senders write them, `2` or `2.0`, before they become whole numbers.
COUNT = T.DecimalType(12, 2)

# One schema covers both channels: nested customer and line_items on one side,
# flat customer fields and products on the other. `age` stays text until it is
# coerced, so that a non-numeric age does not spoil the record.
CORRUPT = "_corrupt"
PAYLOAD = T.StructType(
    [
        T.StructField("transactionId", T.StringType()),
        T.StructField(
            "customer_information",
            T.StructType(
                [
                    T.StructField("name", T.StringType()),
                    T.StructField("address", T.StringType()),
                    T.StructField("age", T.StringType()),
                    T.StructField("gender", T.StringType()),
                    T.StructField("phone", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "line_items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("lineId", T.StringType()),
                        T.StructField("product", T.StringType()),
                        T.StructField("unitPrice", MONEY),
                        T.StructField("quantity", COUNT),
                    ]
                )
            ),
        ),
        T.StructField("total", MONEY),
        T.StructField("mop", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("salesId", T.StringType()),
        T.StructField("fullName", T.StringType()),
        T.StructField("deliveryLoc", T.StringType()),
        T.StructField("age", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("contact", T.StringType()),
        T.StructField(
            "products",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField("name", T.StringType()),
                        T.StructField("price", MONEY),
                        T.StructField("qty", COUNT),
                    ]
                )
            ),
        ),
        T.StructField("amountDue", MONEY),
        T.StructField("paymentType", T.StringType()),
        T.StructField("creationDate", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("job", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("ended_at", T.TimestampType(), False),
        T.StructField("message", T.StringType()),
    ]
)
