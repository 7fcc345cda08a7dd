"""Raw sale payloads of two channels, brought to one header and one line shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.functions.calendar import wall_clock
from tillmart.schemas import CORRUPT, COUNT, HEADER_COLUMNS, PAYLOAD

# Channel names and the texts of an acknowledgment.
NESTED_CHANNEL = "Orange App"
FLAT_CHANNEL = "Blue App"
ACK_STATUS = "Success"
ACK_MESSAGE = "Record created successfully."


def parse_payloads(raw: DataFrame, text: str = "value", kept: Sequence[str] = ()) -> DataFrame:
    """One JSON document per row, as text, to the struct column `payload`, beside `kept` columns.

    The struct comes out of a one-element explode: later filters on its fields then
    stay above it, and are not replaced by one more parse per field they mention.
    """
    parsed = F.from_json(
        F.col(text), PAYLOAD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return raw.select(F.col(text).alias("raw"), F.explode(F.array(parsed)).alias("payload"), *kept)


def _whole(number: Column) -> Column:
    """A number as the integer column of the table takes it: rounded, half away from zero; null
    if it does not fit."""
    return F.round(number).try_cast("int")


def _too_large(number: Column) -> Column:
    return number.isNotNull() & _whole(number).isNull()


def normalize_payloads(parsed: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Header fields, `items` array and `reject_reason` (null when acceptable), then `kept` columns.

    Whether a payload names its sale `transactionId` decides the channel. The
    channel decides where customer and line fields are read; amount, payment type
    and date each take the first name that is filled, whatever the channel. Counts are rounded
    as the tables' integer columns round them; a sale with a count that does not fit is
    rejected, not stored without it.
    """
    p = F.col("payload")
    nested = p["transactionId"].isNotNull()
    customer = p["customer_information"]

    def pick(nested_field: str, flat_field: str) -> Column:
        return F.when(nested, customer[nested_field]).otherwise(p[flat_field])

    nested_items = F.transform(
        p["line_items"],
        lambda line: F.struct(
            line["lineId"].alias("item_id"),
            line["product"].alias("product_name"),
            line["unitPrice"].alias("price"),
            _whole(line["quantity"]).alias("quantity"),
        ),
    )
    flat_items = F.transform(
        p["products"],
        lambda line: F.struct(
            line["id"].alias("item_id"),
            line["name"].alias("product_name"),
            line["price"].alias("price"),
            _whole(line["qty"]).alias("quantity"),
        ),
    )
    age = pick("age", "age").try_cast(COUNT)
    lost = _too_large(age) | F.when(
        nested, F.exists(p["line_items"], lambda line: _too_large(line["quantity"]))
    ).otherwise(F.exists(p["products"], lambda line: _too_large(line["qty"])))
    sale_id = F.coalesce(p["transactionId"], p["salesId"])
    sold_at = wall_clock(F.coalesce(p["timestamp"], p["creationDate"]))
    reason = (
        F.when(p.isNull() | p[CORRUPT].isNotNull(), "malformed document")
        .when(sale_id.isNull(), "no sale id")
        .when(sold_at.isNull(), "no valid date")
        .when(F.coalesce(lost, F.lit(False)), "number does not fit")
    )
    return parsed.select(
        sale_id.alias("transaction_id"),
        F.when(nested, NESTED_CHANNEL).otherwise(FLAT_CHANNEL).alias("source"),
        pick("name", "fullName").alias("customer_name"),
        pick("address", "deliveryLoc").alias("delivery_address"),
        pick("phone", "contact").alias("customer_contact"),
        _whole(age).alias("customer_age"),
        pick("gender", "gender").alias("customer_gender"),
        F.coalesce(p["total"], p["amountDue"]).alias("total_amount"),
        F.coalesce(p["mop"], p["paymentType"]).alias("payment_type"),
        sold_at.alias("transaction_date"),
        F.when(nested, nested_items).otherwise(flat_items).alias("items"),
        reason.alias("reject_reason"),
        F.col("raw"),
        *kept,
    )


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw")


def rejected(normalized: DataFrame) -> DataFrame:
    """Payloads that cannot become a sale, kept whole with the reason."""
    return normalized.filter(F.col("reject_reason").isNotNull()).select(
        payload_digest().alias("payload_digest"), "reject_reason", "raw"
    )


def payload_digest() -> Column:
    """What identifies a payload: its text as it was sent."""
    return F.sha2("raw", 256)


def chosen_payloads(payloads: DataFrame) -> DataFrame:
    """`transaction_id, payload_digest`: of the payloads of a sale, the one it is made of.

    The earliest date wins, then the smallest digest, so a recomputed task picks the same
    one. `min` is combined before the shuffle: a sale sent very often costs one row per task.
    """
    return sent_sales(payloads).drop("payloads")


def sent_sales(payloads: DataFrame) -> DataFrame:
    """The chosen payloads, and how many `payloads` of the sale there are, copies included."""
    kept = payloads.groupBy("transaction_id").agg(
        F.min(F.struct("transaction_date", "payload_digest")).alias("first"),
        F.count(F.lit(1)).alias("payloads"),
    )
    chosen = F.col("first.payload_digest").alias("payload_digest")
    return kept.select("transaction_id", chosen, "payloads")


def sale_headers(sales: DataFrame) -> DataFrame:
    return sales.select(*HEADER_COLUMNS)


def sale_items(sales: DataFrame) -> DataFrame:
    """One row per array element; a sale with an empty or null array has none."""
    return sales.select("transaction_id", F.explode("items").alias("item")).select(
        "item.item_id", "transaction_id", "item.product_name", "item.price", "item.quantity"
    )


def acknowledgments(sales: DataFrame, at: Column | None = None) -> DataFrame:
    return sales.select(
        F.lit(ACK_STATUS).alias("status"),
        F.lit(ACK_MESSAGE).alias("message"),
        F.col("transaction_id").alias("transactionId"),
        (F.current_timestamp() if at is None else at).alias("timestamp"),
    )
