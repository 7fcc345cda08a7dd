"""Sales tables and raw payloads derived from the order tables used for testing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions.calendar import iso_text
from tillmart.schemas import MONEY


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def sales(spark: SparkSession, folder: str, by_shuffle: bool = False) -> DataFrame:
    """Sale headers: one per order."""
    return _headers(spark, folder, table(spark, folder, "orders"), by_shuffle)


def _side(rows: DataFrame, by_shuffle: bool) -> DataFrame:
    """A side of a join; `by_shuffle` keeps it from being broadcast. Spark goes by the size of the
    files, of which well compressed ones are many times as large in the driver's memory."""
    return rows.hint("merge") if by_shuffle else rows


def _headers(
    spark: SparkSession, folder: str, orders: DataFrame, by_shuffle: bool = False
) -> DataFrame:
    customer = _side(table(spark, folder, "customer"), by_shuffle)
    nation = table(spark, folder, "nation")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("transaction_id"),
            F.col("o_orderpriority").alias("source"),
            F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("delivery_address"),
            F.concat(F.lit("+63"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias(
                "customer_contact"
            ),
            (F.col("c_custkey") % 80).cast("int").alias("customer_age"),
            F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("customer_gender"),
            F.col("o_totalprice").cast(MONEY).alias("total_amount"),
            F.col("c_mktsegment").alias("payment_type"),
            F.col("o_orderdate").alias("transaction_date"),
        )
    )


def sales_items(spark: SparkSession, folder: str) -> DataFrame:
    """Sale lines: one per line item."""
    return _lines(spark, folder).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("item_id"),
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        "product_name",
        "price",
        "quantity",
    )


def _lines(spark: SparkSession, folder: str, by_shuffle: bool = False) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    part = _side(table(spark, folder, "part"), by_shuffle)
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def payload_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales as they are sent in, each with all its lines in an array. No table that grows is
    broadcast."""
    # Ids of lines are made after the lines are gathered by their sale.
    short = F.struct("l_linenumber", "product_name", "price", "quantity")

    def line(of: Column) -> Column:
        item_id = F.concat_ws("-", F.col("transaction_id"), of["l_linenumber"]).alias("item_id")
        return F.struct(item_id, of["product_name"], of["price"], of["quantity"])

    arrays = (
        _lines(spark, folder, by_shuffle=True)
        .groupBy(F.col("l_orderkey").cast("string").alias("transaction_id"))
        .agg(F.collect_list(short).alias("lines"))
        .select("transaction_id", F.sort_array(F.transform("lines", line)).alias("items"))
    )
    joined = sales(spark, folder, by_shuffle=True).join(arrays, "transaction_id", "left")
    none = F.array().cast(arrays.schema["items"].dataType)
    return joined.withColumn("items", F.coalesce("items", none))


def with_amended(sent: DataFrame) -> DataFrame:
    """The sales, and the same sent once more a day later with another amount (`is_amended`)."""
    later = F.col("transaction_date") + F.expr("INTERVAL 1 DAY")
    more = (F.col("total_amount") + 1).cast(MONEY)
    is_amended = F.col("is_amended")
    return sent.withColumn("is_amended", F.explode(F.array(F.lit(False), F.lit(True)))).withColumns(
        {
            "transaction_date": F.when(is_amended, later).otherwise(F.col("transaction_date")),
            "total_amount": F.when(is_amended, more).otherwise(F.col("total_amount")),
        }
    )


def raw_payloads(spark: SparkSession, folder: str) -> DataFrame:
    return as_payloads(payload_sales(spark, folder))


def as_payloads(sent: DataFrame, *kept: str) -> DataFrame:
    """One JSON document per sale, beside `kept` columns: odd sale numbers come nested, even ones
    flat."""
    odd = F.col("transaction_id").cast("long") % 2 == 1
    local_time = iso_text(F.col("transaction_date"))
    nested = F.struct(
        F.col("transaction_id").alias("transactionId"),
        F.struct(
            F.col("customer_name").alias("name"),
            F.col("delivery_address").alias("address"),
            F.col("customer_age").alias("age"),
            F.col("customer_gender").alias("gender"),
            F.col("customer_contact").alias("phone"),
        ).alias("customer_information"),
        F.transform(
            "items",
            lambda i: F.struct(
                i["item_id"].alias("lineId"),
                i["product_name"].alias("product"),
                i["price"].alias("unitPrice"),
                i["quantity"],
            ),
        ).alias("line_items"),
        F.col("total_amount").alias("total"),
        F.col("payment_type").alias("mop"),
        F.concat(local_time, F.lit("+08:00")).alias("timestamp"),
    )
    flat = F.struct(
        F.col("transaction_id").alias("salesId"),
        F.col("customer_name").alias("fullName"),
        F.col("delivery_address").alias("deliveryLoc"),
        # Some senders give no usable age.
        F.when(F.col("customer_age") % 10 == 3, "n/a")
        .otherwise(F.col("customer_age").cast("string"))
        .alias("age"),
        F.col("customer_gender").alias("gender"),
        F.col("customer_contact").alias("contact"),
        F.transform(
            "items",
            lambda i: F.struct(
                i["item_id"].alias("id"),
                i["product_name"].alias("name"),
                i["price"],
                i["quantity"].alias("qty"),
            ),
        ).alias("products"),
        F.col("total_amount").alias("amountDue"),
        F.col("payment_type").alias("paymentType"),
        F.concat(local_time, F.lit("Z")).alias("creationDate"),
    )
    text = F.when(odd, F.to_json(nested)).otherwise(F.to_json(flat))
    return sent.select(text.alias("value"), *kept)


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Job log lines: each event is one datamart step that starts and finishes."""
    events = table(spark, folder, "events")
    name = F.concat(F.lit("dm_sales."), "event_type", F.lit("_"), F.col("user_id").cast("string"))
    started = F.col("ts")
    ended = started + F.make_dt_interval(secs=F.col("event_id") % 7)

    def line(at: Column, message: Column) -> Column:
        return F.concat(F.translate(iso_text(at), "T", " "), F.lit(" INFO: "), message)

    first = line(started, F.concat(F.lit("Creating/Overwriting datamart table: "), name))
    last = line(
        ended,
        F.concat(
            F.lit("Finished writing "), name, F.lit(" | Rows: "), F.col("event_id").cast("string")
        ),
    )
    return events.select(F.explode(F.array(first, last)).alias("value"))
