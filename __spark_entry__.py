
from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions.masking import mask_columns
from tillmart.operators.days import MONTH_COLUMN, Days, on_days, with_month
from tillmart.operators.documents import document_json, requested_documents, sale_documents
from tillmart.operators.lines import sold_by_product
from tillmart.operators.lookup import header_lookup, items_lookup
from tillmart.operators.versions import current_rows
from tillmart.plans import export, marts, worksheets
from tillmart.plans.cube import Cube, write_cube
from tillmart.plans.ingest import TableConfig, reconcile_rows, run_ingest
from tillmart.plans.log_report import load_log, log_report
from tillmart.schemas import HEADER_COLUMNS, SALES_FULL_COLUMNS, WIDE_MONEY
from tillmart.sources import driver_tables as source
from tillmart.sources import payloads
from tillmart.sources.scratch import passing_shuffles, scratch_dir
from tillmart.sources.splits import EquiDepth, equi_depth, part_sizes
from tillmart.sources.stores import FolderStore
from tillmart.streaming.intake import SUPERSEDED, SalesIntake

SMOKE_DIR = "/root/testdata/sf0.001"

# The days a viewer has selected on the trend, and the time of an earlier load.
SELECTED_DAYS = [date(1996, 1, 2), date(1996, 1, 3), date(1997, 6, 30), date(2000, 2, 29)]
EARLIER = "2024-01-20"


def entry(spark: SparkSession) -> DataFrame:
    """Measures per product and source, best-selling product first."""
    return bi_product_performance(spark, SMOKE_DIR)


# --- sources and lookups ---------------------------------------------------------


def _given(spark: SparkSession, folder: str) -> FolderStore:
    return FolderStore(spark, folder, suffix=".parquet")


def _scratch(spark: SparkSession, label: str) -> FolderStore:
    return FolderStore(spark, scratch_dir(spark, label))


def _sales_full(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sales_full(source.sales(spark, folder), source.sales_items(spark, folder))


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requested sale ids, some of which do not exist."""
    events = source.table(spark, folder, "events")
    return events.select((F.col("event_id") * 2).cast("string").alias("transaction_id"))


def scan_table(spark: SparkSession, folder: str) -> DataFrame:
    return _given(spark, folder).read("lineitem")


def scan_query(spark: SparkSession, folder: str) -> DataFrame:
    store = _given(spark, folder)
    store.register("orders", "customer")
    return store.query(
        "SELECT c_mktsegment AS segment, COUNT(o_orderkey) AS transactions, "
        "CAST(SUM(CAST(o_totalprice AS DECIMAL(10, 2))) AS DECIMAL(38, 2)) AS total_sales "
        "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"
    )


def scan_split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of equal size over lines of which a third share one key and some have none: rows
    in no part and in several, and whether no part is half as large again as an even one."""
    key = F.when(F.col("l_linenumber") != 7, F.col("l_orderkey"))
    lines = source.table(spark, folder, "lineitem").select(
        F.when(key % 3 == 0, 1).otherwise(key).alias("key"), "l_extendedprice"
    )
    ranges = equi_depth(lines, EquiDepth("key", 8, within="l_extendedprice"))
    sizes = part_sizes(lines, ranges)
    placed = F.when(F.col("part") >= 0, F.col("rows"))
    return sizes.agg(
        F.sum("rows").alias("line_count"),
        F.sum(F.when(F.col("part") == -1, F.col("rows")).otherwise(0)).alias("in_no_part"),
        F.sum(F.when(F.col("part") == -2, F.col("rows")).otherwise(0)).alias("in_two_parts"),
        (F.max(placed) <= 1.5 * F.sum("rows") / 8).alias("near_equal"),
    )


def sale_header_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return header_lookup(source.sales(spark, folder), _requests(spark, folder))


def sale_items_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return items_lookup(source.sales_items(spark, folder), _requests(spark, folder))


def sale_document(spark: SparkSession, folder: str) -> DataFrame:
    documents = sale_documents(source.sales(spark, folder), source.sales_items(spark, folder))
    return documents.select("transactionId", "part", document_json(documents).alias("document"))


def sale_document_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose lines are dealt to four parts by content."""
    documents = sale_documents(
        source.sales(spark, folder), source.sales_items(spark, folder), parts=4
    )
    return documents.select("transactionId", "part", document_json(documents).alias("document"))


def sale_document_requested(spark: SparkSession, folder: str) -> DataFrame:
    documents = requested_documents(
        source.sales(spark, folder), source.sales_items(spark, folder), _requests(spark, folder)
    )
    return documents.select("requested_id", "part", document_json(documents).alias("document"))


# --- payloads --------------------------------------------------------------------


def payload_parse(spark: SparkSession, folder: str) -> DataFrame:
    parsed = payloads.parse_payloads(source.raw_payloads(spark, folder))
    p = F.col("payload")
    return parsed.select(
        p["transactionId"].alias("transaction_id"),
        p["salesId"].alias("sales_id"),
        p["customer_information"]["name"].alias("nested_name"),
        p["fullName"].alias("flat_name"),
        p["age"].alias("flat_age"),
        p["total"].alias("total"),
        p["amountDue"].alias("amount_due"),
        F.size(F.coalesce(p["line_items"], F.array().cast(_type(parsed, "line_items")))).alias(
            "nested_lines"
        ),
        F.size(F.coalesce(p["products"], F.array().cast(_type(parsed, "products")))).alias(
            "flat_lines"
        ),
    )


def _type(parsed: DataFrame, name: str):
    return parsed.schema["payload"].dataType[name].dataType


def _taken(spark: SparkSession, folder: str) -> DataFrame:
    parsed = payloads.parse_payloads(source.raw_payloads(spark, folder))
    return payloads.accepted(payloads.normalize_payloads(parsed))


def payload_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return _taken(spark, folder).select(*HEADER_COLUMNS, F.size("items").alias("item_count"))


def payload_to_sales(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.sale_headers(_taken(spark, folder))


def payload_to_items(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.sale_items(_taken(spark, folder))


def payload_documents(spark: SparkSession, folder: str) -> DataFrame:
    """From the payload to the tables and back to the document."""
    stored = f"{scratch_dir(spark, 'taken')}/rows"
    # Payloads are made and parsed once for both tables.
    _taken(spark, folder).write.parquet(stored, compression="zstd")
    taken = spark.read.parquet(stored)
    documents = sale_documents(payloads.sale_headers(taken), payloads.sale_items(taken))
    return documents.select("transactionId", document_json(documents).alias("document"))


def payload_ack(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.acknowledgments(_taken(spark, folder)).drop("timestamp")


def payload_ack_stamp(spark: SparkSession, folder: str) -> DataFrame:
    """The time of the acknowledgments: one value for all of a run."""
    return _stamps(payloads.acknowledgments(_taken(spark, folder)), "acknowledgments", "timestamp")


def _damaged() -> Column:
    """A payload's text, but cut short, without its id, or without its date."""
    kind = F.split("value", '"')[3].cast("long") % 3
    cut = F.expr("left(value, length(value) - 1)")
    nameless = F.regexp_replace("value", '"(transactionId|salesId)":', '"other":')
    undated = F.regexp_replace("value", '"(timestamp|creationDate)":"', '"$1":"on ')
    return F.when(kind == 0, cut).when(kind == 1, nameless).otherwise(undated)


def payload_rejects(spark: SparkSession, folder: str) -> DataFrame:
    raw = source.raw_payloads(spark, folder)
    sent = raw.select(F.explode(F.array("value", _damaged())).alias("value"))
    normalized = payloads.normalize_payloads(payloads.parse_payloads(sent))
    rejects = payloads.rejected(normalized)
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("payloads"))


def stream_payload_intake(spark: SparkSession, folder: str) -> DataFrame:
    """Stream all payloads, each sent twice, a differing one of each sale, and damaged ones;
    then replay them all. `superseded` counts the differing payloads kept as rejects."""
    store = _scratch(spark, "intake")
    sent = source.with_amended(source.payload_sales(spark, folder))
    raw = source.as_payloads(sent, "is_amended")
    copies = F.array("value", "value", _damaged())
    texts = F.when(F.col("is_amended"), F.array("value")).otherwise(copies)
    with passing_shuffles(spark):
        raw.select(F.explode(texts).alias("value")).write.text(
            f"{store.root}/payloads", compression="gzip"
        )
    intake = SalesIntake(store)
    for attempt in ("first", "replay"):
        intake.start(
            spark, f"{store.root}/payloads", f"{store.root}/checkpoint-{attempt}"
        ).awaitTermination()
    sales = intake.read(intake.sales_table).select(*HEADER_COLUMNS)
    lines = (
        intake.read(intake.items_table)
        .groupBy("transaction_id")
        .agg(
            F.count(F.lit(1)).alias("item_count"),
            F.sum(F.col("price") * F.col("quantity")).cast(WIDE_MONEY).alias("item_total"),
        )
    )
    rejects = intake.read(intake.rejects_table).filter(F.col("reject_reason") == SUPERSEDED)
    named = F.coalesce(
        F.get_json_object("raw", "$.transactionId"), F.get_json_object("raw", "$.salesId")
    )
    superseded = rejects.groupBy(named.alias("transaction_id")).agg(
        F.count(F.lit(1)).alias("superseded")
    )
    return sales.join(lines, "transaction_id", "left").join(superseded, "transaction_id", "left")


def stream_intake_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Stream all payloads in four batches that are rewritten in pairs, and then replay them."""
    store = _scratch(spark, "intake-merged")
    raw = source.raw_payloads(spark, folder)
    # Each task writes a file for each batch; rows are dealt by their places, without a shuffle.
    dealt = raw.withColumn("part", F.monotonically_increasing_id() % 4)
    with passing_shuffles(spark):
        dealt.write.partitionBy("part").text(f"{store.root}/payloads", compression="gzip")
    sent = len(spark.read.text(f"{store.root}/payloads").inputFiles())
    intake = SalesIntake(store, merge_at=2)
    for attempt, files in (("first", -(-sent // 4)), ("replay", sent)):
        intake.start(
            spark, f"{store.root}/payloads", f"{store.root}/checkpoint-{attempt}", files_per_batch=files
        ).awaitTermination()
    held = intake.committed()
    documents = sale_documents(held.read(intake.sales_table), held.read(intake.items_table))
    return documents.select("transactionId", document_json(documents).alias("document"))


# --- ingest ----------------------------------------------------------------------


def _ingest(spark: SparkSession, given, target, table: str, times: int = 1, **config) -> DataFrame:
    entry = {"source_table": table, "target_schema": "staging", "target_table": table} | config
    for _ in range(times):
        run_ingest(spark, given, target, [TableConfig.from_dict(entry)], [table])
    return target.read(f"staging.{table}").drop("ingest_timestamp")


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def ingest_full(spark: SparkSession, folder: str) -> DataFrame:
    return _ingest(
        spark, _given(spark, folder), _scratch(spark, "full"), "orders",
        times=2, fields="*", load_type="FULL", delta_column="o_orderdate",
    )


def ingest_stamp(spark: SparkSession, folder: str) -> DataFrame:
    """The audit column of a full load: one value for every row of the run."""
    target = _scratch(spark, "stamp")
    _ingest(spark, _given(spark, folder), target, "orders", fields="*", load_type="full")
    return _stamps(target.read("staging.orders"), "staging.orders", "ingest_timestamp")


def _stamps(rows: DataFrame, table: str, column: str) -> DataFrame:
    return rows.agg(
        F.lit(table).alias("table_name"),
        F.count(column).alias("stamped_rows"),
        F.count_distinct(column).alias("stamps"),
    ).select("table_name", "stamped_rows", "stamps")


def ingest_append(spark: SparkSession, folder: str) -> DataFrame:
    return _ingest(
        spark, _given(spark, folder), _scratch(spark, "append"), "orders",
        times=2, fields="*", load_type="delta",
    )


def ingest_projection(spark: SparkSession, folder: str) -> DataFrame:
    return _ingest(
        spark, _given(spark, folder), _scratch(spark, "projection"), "orders",
        fields="o_orderkey, o_custkey ,o_totalprice", load_type="full",
    )


def ingest_delta(spark: SparkSession, folder: str) -> DataFrame:
    target = _scratch(spark, "delta")
    events = source.table(spark, folder, "events")
    target.write(events.filter(F.col("ts") < _at(EARLIER)), "staging.events", "overwrite")
    return _ingest(
        spark, _given(spark, folder), target, "events",
        times=2, fields="*", load_type="delta", delta_column="ts",
    )


def ingest_delta_empty_target(spark: SparkSession, folder: str) -> DataFrame:
    target = _scratch(spark, "delta-empty")
    nothing = spark.createDataFrame([], source.table(spark, folder, "events").schema)
    target.write(nothing, "staging.events", "overwrite")
    return _ingest(
        spark, _given(spark, folder), target, "events",
        fields="*", load_type="delta", delta_column="ts",
    )


def ingest_delta_null_key(spark: SparkSession, folder: str) -> DataFrame:
    given, target = _scratch(spark, "null-source"), _scratch(spark, "null-target")
    events = source.table(spark, folder, "events")
    undated = events.withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    given.write(undated, "events", "overwrite")
    target.write(undated.filter(F.col("ts") < _at(EARLIER)), "staging.events", "overwrite")
    return _ingest(
        spark, given, target, "events",
        fields="*", load_type="delta", delta_column="ts",
    )


def ingest_delta_ties(spark: SparkSession, folder: str) -> DataFrame:
    """The delta column is a day, and the last loaded day was loaded in part."""
    given, target = _scratch(spark, "ties-source"), _scratch(spark, "ties-target")
    events = source.table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    given.write(events, "events", "overwrite")
    target.write(events.filter(F.col("ts") < _at(f"{EARLIER} 12:00:00")), "staging.events", "overwrite")
    return _ingest(
        spark, given, target, "events",
        times=2, fields="*", load_type="delta", delta_column="day", tie_key="event_id",
    )


def ingest_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    configs = [
        TableConfig.from_dict(
            {"source_table": table, "target_table": table, "fields": "*", "load_type": "full"}
        )
        for table in ("orders", "lineitem")
    ]
    audit = run_ingest(
        spark, _given(spark, folder), _scratch(spark, "reconcile"), configs,
        ["orders", "nowhere", "lineitem"], reconcile=True,
    )
    return audit.select("job", "table_name", "status", "rows_in", "rows_out", "message")


def ingest_delta_current(spark: SparkSession, folder: str) -> DataFrame:
    """Three delta loads, the later ones with updates of every third and every fourth order;
    the current row of each order."""
    given, target = _scratch(spark, "updates-source"), _scratch(spark, "updates-target")
    orders = source.table(spark, folder, "orders").withColumnRenamed("o_orderdate", "modified")
    for load in range(3):
        key = F.col("o_orderkey")
        last = F.when(F.lit(load >= 2) & (key % 4 == 0), 2).when(F.lit(load >= 1) & (key % 3 == 0), 1)
        at = F.when(last == 2, _at("2030-01-02")).when(last == 1, _at("2030-01-01"))
        state = orders.withColumns(
            {
                "o_totalprice": F.col("o_totalprice") + F.coalesce(last, F.lit(0)),
                "modified": F.coalesce(at, F.col("modified")),
            }
        )
        given.write(state, f"orders_{load}", "overwrite")
        entry = {"source_table": f"orders_{load}", "target_schema": "staging", "target_table": "orders",
                 "fields": "*", "load_type": "delta", "delta_column": "modified"}
        run_ingest(spark, given, target, [TableConfig.from_dict(entry)], [f"orders_{load}"])
    loaded = target.read("staging.orders")
    return current_rows(loaded, ["o_orderkey"], ["modified", "ingest_timestamp"]).drop("ingest_timestamp")


def ingest_reconcile_content(spark: SparkSession, folder: str) -> DataFrame:
    """A target in which orders were changed, lost, doubled, and made up."""
    target = _scratch(spark, "content")
    orders = source.table(spark, folder, "orders")
    case = F.col("o_orderkey") % 100
    price = F.when(case == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    wrong = (
        orders.filter(case != 2)
        .withColumn("o_totalprice", price)
        .union(orders.filter(case == 3))
        .union(orders.filter(case == 4).withColumn("o_orderkey", -F.col("o_orderkey")))
    )
    target.write(wrong, "orders", "overwrite")
    config = {"source_table": "orders", "target_table": "orders", "fields": "*", "load_type": "full"}
    return reconcile_rows(
        _given(spark, folder), target, TableConfig.from_dict(config), ["o_orderkey"]
    )


def _staged(spark: SparkSession, folder: str) -> FolderStore:
    staging = _scratch(spark, "staging")
    with passing_shuffles(spark):
        staging.write(source.sales(spark, folder), "sales_transactions.sales", "overwrite")
        staging.write(source.sales_items(spark, folder), "sales_transactions.sales_items", "overwrite")
    return staging


def run_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Write the five datamarts from staged tables, export them, return the audit table."""
    target = _scratch(spark, "marts")
    audit = (target, "audit.runs")
    marts.run_datamarts(spark, _staged(spark, folder), target, audit=audit)
    names = [mart.target_table for mart in marts.MARTS]
    export.run_export(spark, target, names, f"{target.root}/exported", audit=audit)
    name = F.regexp_extract("message", r"([^/]+)_\d{8}_\d{6}$", 1)
    return target.read("audit.runs").select(
        "job",
        "table_name",
        "status",
        "rows_out",
        F.when(F.col("job") == "export", name).alias("folder"),
    )


def log_report_steps(spark: SparkSession, folder: str) -> DataFrame:
    store = _scratch(spark, "log")
    source.event_log(spark, folder).write.text(f"{store.root}/lines")
    return log_report(load_log(spark, f"{store.root}/lines", store, "steps"))


# --- masks and datamarts -----------------------------------------------------------


def mask_hash(spark: SparkSession, folder: str) -> DataFrame:
    sales = source.sales(spark, folder).select("transaction_id", "customer_name", "customer_age")
    return mask_columns(sales, {"customer_name": "hash", "customer_age": "hash"})


def mask_fixed(spark: SparkSession, folder: str) -> DataFrame:
    sales = source.sales(spark, folder).select(
        "transaction_id", "delivery_address", "customer_gender"
    )
    return mask_columns(sales, {"delivery_address": "fixed", "customer_gender": "fixed"})


def mask_partial(spark: SparkSession, folder: str) -> DataFrame:
    sales = source.sales(spark, folder).select(
        "transaction_id", "customer_contact", "customer_gender", "total_amount"
    )
    return mask_columns(
        sales,
        {"customer_contact": "partial", "customer_gender": "partial", "total_amount": "partial"},
    )


def mask_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    sales = source.sales(spark, folder).drop("transaction_date")
    masks = {"customer_name": "HASH", "delivery_address": "Fixed", "customer_contact": "Partial"}
    return mask_columns(sales, masks | {"no_such_column": "hash"})


def dm_top_selling_products_semi(spark: SparkSession, folder: str) -> DataFrame:
    """The same mart where headers are known to be unique: an existence check."""
    return sold_by_product(
        source.sales(spark, folder), source.sales_items(spark, folder), unique_headers=True
    )


def _mart(mart: marts.Mart) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        sales, items = source.sales(spark, folder), source.sales_items(spark, folder)
        return marts.mart_rows(mart, sales, items)

    return query


def _mart_positions(mart: marts.Mart) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return marts.mart_positions(mart, *_tables(spark, folder))

    return query


def dm_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return marts.top_products(*_tables(spark, folder), k=10)


def dm_top_products_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return marts.top_products_by_source(*_tables(spark, folder), k=3)


def _shared_mart(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """A mart over headers, built with the others of its kind from one scan of them."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        target = _scratch(spark, "shared-marts")
        over_headers = [mart for mart in marts.MARTS if mart.target_table in marts.HEADER_GROUPS]
        marts.run_datamarts(spark, _staged(spark, folder), target, over_headers, one_header_scan=True)
        return target.read(table).drop(marts.STAMP_COLUMN)

    return query


# The five marts as statements of a JSON configuration; a run puts in its own staging schema.
SQL_MARTS = [
    {
        "target_table": "dm_sales.top_selling_products",
        "sql": "SELECT product_name, SUM(quantity) AS total_sold, "
        "CAST(SUM(price * quantity) AS DECIMAL(38, 2)) AS total_revenue "
        "FROM sales_transactions.sales_items JOIN sales_transactions.sales USING (transaction_id) "
        "GROUP BY product_name",
    },
    {
        "target_table": "dm_sales.sales_by_source",
        "sql": "SELECT source, CAST(SUM(total_amount) AS DECIMAL(38, 2)) AS total_sales, "
        "COUNT(transaction_id) AS transactions FROM sales_transactions.sales GROUP BY source",
    },
    {
        "target_table": "dm_sales.customer_demographics",
        "sql": "SELECT customer_gender, CAST(customer_age DIV 10 * 10 AS DOUBLE) AS age_group, "
        "COUNT(*) AS count_customers, CAST(SUM(total_amount) AS DECIMAL(38, 2)) AS total_spent, "
        "customer_name, delivery_address, customer_contact FROM sales_transactions.sales "
        "GROUP BY customer_gender, age_group, customer_name, delivery_address, customer_contact",
        "mask_columns": dict(marts.PERSONAL_FIELDS),
    },
    {
        "target_table": "dm_sales.sales_trend",
        "sql": "SELECT CAST(DATE_TRUNC('MONTH', transaction_date) AS TIMESTAMP_NTZ) AS month, "
        "CAST(SUM(total_amount) AS DECIMAL(38, 2)) AS monthly_sales "
        "FROM sales_transactions.sales GROUP BY month",
    },
    {
        "target_table": "dm_sales.sales_full",
        "sql": f"SELECT {', '.join(SALES_FULL_COLUMNS)} FROM sales_transactions.sales_items "
        "JOIN sales_transactions.sales USING (transaction_id)",
        "mask_columns": dict(marts.PERSONAL_FIELDS),
    },
]


def _written_sql_marts(spark: SparkSession, folder: str, raw: list[dict]) -> FolderStore:
    staging, target = _staged(spark, folder), _scratch(spark, "sql-marts")
    schema = f"staging_{uuid.uuid4().hex}"
    own = [entry | {"sql": entry["sql"].replace("sales_transactions", schema)} for entry in raw]
    with staging.registered(
        "sales_transactions.sales", "sales_transactions.sales_items", schema=schema
    ):
        marts.run_datamarts(spark, staging, target, [marts.Mart.from_dict(entry) for entry in own])
    return target


def _sql_mart(raw: dict) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        target = _written_sql_marts(spark, folder, [raw])
        return target.read(raw["target_table"]).drop(marts.STAMP_COLUMN)

    return query


def dm_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """The audit column of the five marts: one value for every row of the run."""
    target = _written_sql_marts(spark, folder, SQL_MARTS)
    names = [raw["target_table"] for raw in SQL_MARTS]
    parts = [_stamps(target.read(name), name, marts.STAMP_COLUMN) for name in names]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.union(part)
    return combined


def export_csv_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of two exports as other programs see them, each header once.

    The offset of date-times, which is the session's, is taken off.
    """
    offset = r"(T\d\d:\d\d:\d\d\.\d\d\d)(Z|[+-]\d\d:\d\d)"
    rows = export.as_exported(marts.mart_rows(marts.SALES_BY_SOURCE, *_tables(spark, folder)))
    full = export.as_exported(_sales_full(spark, folder))
    base = scratch_dir(spark, "export-lines")
    found = []
    for name, df in (("sales_by_source", rows), ("sales_full", full)):
        export.write_csv(df, f"{base}/{name}")
        lines = spark.read.text(f"{base}/{name}").select(
            F.lit(name).alias("export"), F.regexp_replace("value", offset, "$1").alias("line")
        )
        is_header = F.startswith("line", F.lit(df.columns[0] + ","))
        found += [lines.filter(~is_header), lines.filter(is_header).distinct()]
    combined = found[0]
    for part in found[1:]:
        combined = combined.union(part)
    return combined


def _tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return source.sales(spark, folder), source.sales_items(spark, folder)


def export_ordered_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of ordered marts, exported in four files each, in the order of the file names."""
    base = scratch_dir(spark, "ordered-lines")
    found = []
    for mart in (marts.TOP_SELLING_PRODUCTS, marts.SALES_TREND):
        rows = export.as_exported(mart.build(*_tables(spark, folder)))
        path = f"{base}/{mart.target_table}"
        export.write_csv(rows, path, order=mart.order(), files=4)
        line = F.regexp_replace("line", r"(T\d\d:\d\d:\d\d\.\d\d\d)(Z|[+-]\d\d:\d\d)", "$1")
        lines = export.ordered_lines(spark, path)
        found.append(lines.select(F.lit(mart.target_table).alias("export"), "position", line.alias("line")))
    return found[0].union(found[1])


def export_csv_dialect(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of values with quotes, commas and blanks, of empty text and of null."""
    part, name = source.table(spark, folder, "part"), F.col("p_name")
    kind = F.col("p_partkey") % 7
    note = (
        F.when(kind == 0, F.concat(F.lit("  "), name, F.lit(" ")))
        .when(kind == 1, F.concat(F.lit('say "'), name, F.lit('"')))
        .when(kind == 2, F.concat(name, F.lit(", vol. 2")))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.lit('"'))
        .when(kind == 5, name)
    )
    path = f"{scratch_dir(spark, 'dialect')}/parts"
    rows = part.select("p_partkey", note.alias("note"), kind.alias("kind"))
    export.write_csv(rows, path, order=[F.asc("p_partkey")])
    return export.ordered_lines(spark, path)


def export_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sales_full(spark, folder)
    path = f"{scratch_dir(spark, 'export')}/{export.folder_name('dm_sales.sales_full', datetime.now())}"
    export.write_csv(rows, path, lossless=True)
    return export.read_csv(spark, path, rows.schema)


# --- dashboard -------------------------------------------------------------------


def bi_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return worksheets.kpis(_sales_full(spark, folder))


def bi_kpis_long(spark: SparkSession, folder: str) -> DataFrame:
    return worksheets.kpis_long(_sales_full(spark, folder))


def bi_product_performance(spark: SparkSession, folder: str) -> DataFrame:
    return worksheets.product_performance(_sales_full(spark, folder))


def bi_product_performance_positions(spark: SparkSession, folder: str) -> DataFrame:
    return worksheets.product_performance_positions(_sales_full(spark, folder))


def bi_quantity_per_product(spark: SparkSession, folder: str) -> DataFrame:
    return worksheets.quantity_per_product(_sales_full(spark, folder))


def bi_sales_over_time(spark: SparkSession, folder: str) -> DataFrame:
    return worksheets.sales_over_time(_sales_full(spark, folder))


def bi_sales_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return worksheets.sales_by_source(_sales_full(spark, folder))


def bi_count_products(spark: SparkSession, folder: str) -> DataFrame:
    return worksheets.count_products(_sales_full(spark, folder))


def bi_default_measures(spark: SparkSession, folder: str) -> DataFrame:
    return worksheets.default_measures(_sales_full(spark, folder))


def bi_total_sales_header_grain(spark: SparkSession, folder: str) -> DataFrame:
    return worksheets.total_sales_header_grain(source.sales(spark, folder))


def bi_day_filter(spark: SparkSession, folder: str) -> DataFrame:
    return on_days(_sales_full(spark, folder), SELECTED_DAYS)


def bi_day_filter_all(spark: SparkSession, folder: str) -> DataFrame:
    """No selection keeps every row."""
    return on_days(_sales_full(spark, folder), None)


def bi_day_filter_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The day filter on the stored mart, of which only the chosen months are read."""
    target = _scratch(spark, "by-month")
    by_month = replace(marts.SALES_FULL, by_month=True)
    marts.run_datamarts(spark, _staged(spark, folder), target, [by_month])
    stored = on_days(target.read(by_month.target_table), SELECTED_DAYS)
    return stored.select(*SALES_FULL_COLUMNS)


def bi_day_filter_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The days come as a table; on the stored mart their months prune its partitions."""
    target = _scratch(spark, "by-month")
    by_month = replace(marts.SALES_FULL, by_month=True)
    marts.run_datamarts(spark, _staged(spark, folder), target, [by_month])
    events = source.table(spark, folder, "events")
    days = events.filter(F.col("event_type") == "error").select(
        F.make_date(F.lit(1996), F.month("ts"), F.dayofmonth("ts")).alias("day")
    )
    stored = on_days(target.read(by_month.target_table), days)
    return stored.select(*SALES_FULL_COLUMNS)


def bi_captions(spark: SparkSession, folder: str) -> DataFrame:
    return worksheets.captioned(bi_product_performance(spark, folder))


def _cube(spark: SparkSession, folder: str) -> Cube:
    target = _scratch(spark, "cube")
    write_cube(_sales_full(spark, folder), target)
    return Cube.read(target)


# Selections of a viewer: the chosen days, the first half of a year, and none.
SELECTIONS = {
    "days": SELECTED_DAYS,
    "half year": [date(1997, 1, 1) + timedelta(days=n) for n in range(181)],
    "all": None,
}


def _selected(sheet: Callable[[Days], DataFrame]) -> DataFrame:
    parts = [sheet(days).withColumn("selection", F.lit(name)) for name, days in SELECTIONS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def bi_cube_kpis(spark: SparkSession, folder: str) -> DataFrame:
    """KPIs of three selections from the cube, distinct counts included."""
    return _selected(_cube(spark, folder).kpis)


def bi_cube_performance(spark: SparkSession, folder: str) -> DataFrame:
    return _selected(_cube(spark, folder).product_performance)


def bi_dashboard_cube(spark: SparkSession, folder: str) -> DataFrame:
    """All sheets of the dashboard under a selection, from the cube."""
    return _dashboard_rows(_cube(spark, folder).dashboard(SELECTED_DAYS))


def bi_dashboard_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """All sheets of the dashboard under a selection, as sheet, labels, measure, value.

    The mart is written once, and all sheets read the stored table.
    """
    target, table = _scratch(spark, "dashboard"), marts.SALES_FULL.target_table
    target.write(with_month(_sales_full(spark, folder)), table, "overwrite", [MONTH_COLUMN])
    return _dashboard_rows(worksheets.dashboard(target.read(table), SELECTED_DAYS))


def _dashboard_rows(sheets: dict[str, DataFrame]) -> DataFrame:
    labels = {
        "KPIs": [],
        "Product Performance": ["product_name", "source"],
        "Quantity Sold per Product": ["product_name"],
        "Sales Trend": ["day"],
        "Sales by Source": ["source"],
    }
    parts = []
    for sheet, dims in labels.items():
        rows = sheets[sheet].drop("share")
        measures = [name for name in rows.columns if name not in dims]
        cells = rows.select(
            F.lit(sheet).alias("sheet"),
            F.concat_ws(" / ", *[F.col(name).cast("string") for name in dims]).alias("label"),
            *[F.col(name).cast(WIDE_MONEY).alias(name) for name in measures],
        )
        parts.append(cells.unpivot(["sheet", "label"], measures, "measure", "value"))
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.union(part)
    return combined


def llm_registered() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators; none where they are not installed."""
    try:
        import corpus_pipeline
        from tillmart.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name in ("corpus_pipeline", "tillmart.llm"):
            return {}, {}
        raise
    pipeline_sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return llm.QUERIES | {"pipeline": corpus_pipeline.run}, llm.SQL | pipeline_sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return sales_queries() | llm_registered()[0]


def oracle_sql() -> dict[str, str]:
    return sales_sql() | llm_registered()[1]


def sales_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_table": scan_table,
        "scan_query": scan_query,
        "scan_split_sizes": scan_split_sizes,
        "sale_header_lookup": sale_header_lookup,
        "sale_items_lookup": sale_items_lookup,
        "sale_document": sale_document,
        "sale_document_parts": sale_document_parts,
        "sale_document_requested": sale_document_requested,
        "payload_parse": payload_parse,
        "payload_normalize": payload_normalize,
        "payload_to_sales": payload_to_sales,
        "payload_to_items": payload_to_items,
        "payload_documents": payload_documents,
        "payload_ack": payload_ack,
        "payload_ack_stamp": payload_ack_stamp,
        "payload_rejects": payload_rejects,
        "stream_payload_intake": stream_payload_intake,
        "stream_intake_merged": stream_intake_merged,
        "ingest_full": ingest_full,
        "ingest_stamp": ingest_stamp,
        "ingest_append": ingest_append,
        "ingest_projection": ingest_projection,
        "ingest_delta": ingest_delta,
        "ingest_delta_empty_target": ingest_delta_empty_target,
        "ingest_delta_null_key": ingest_delta_null_key,
        "ingest_delta_ties": ingest_delta_ties,
        "ingest_delta_current": ingest_delta_current,
        "ingest_reconcile": ingest_reconcile,
        "ingest_reconcile_content": ingest_reconcile_content,
        "run_audit": run_audit,
        "log_report": log_report_steps,
        "mask_hash": mask_hash,
        "mask_fixed": mask_fixed,
        "mask_partial": mask_partial,
        "mask_dispatch": mask_dispatch,
        "dm_top_selling_products": _mart(marts.TOP_SELLING_PRODUCTS),
        "dm_top_selling_products_semi": dm_top_selling_products_semi,
        "dm_sales_by_source": _mart(marts.SALES_BY_SOURCE),
        "dm_customer_demographics": _mart(marts.CUSTOMER_DEMOGRAPHICS),
        "dm_sales_trend": _mart(marts.SALES_TREND),
        "dm_sales_full": _mart(marts.SALES_FULL),
        **{
            f"dm_sql_{raw['target_table'].split('.')[1]}": _sql_mart(raw) for raw in SQL_MARTS
        },
        **{
            f"dm_shared_{table.split('.')[1]}": _shared_mart(table) for table in marts.HEADER_GROUPS
        },
        "dm_top_selling_products_positions": _mart_positions(marts.TOP_SELLING_PRODUCTS),
        "dm_sales_trend_positions": _mart_positions(marts.SALES_TREND),
        "dm_top_products": dm_top_products,
        "dm_top_products_by_source": dm_top_products_by_source,
        "dm_stamps": dm_stamps,
        "export_ordered_lines": export_ordered_lines,
        "export_csv_dialect": export_csv_dialect,
        "export_csv_roundtrip": export_csv_roundtrip,
        "export_csv_lines": export_csv_lines,
        "bi_kpis": bi_kpis,
        "bi_kpis_long": bi_kpis_long,
        "bi_product_performance": bi_product_performance,
        "bi_product_performance_positions": bi_product_performance_positions,
        "bi_quantity_per_product": bi_quantity_per_product,
        "bi_sales_over_time": bi_sales_over_time,
        "bi_sales_by_source": bi_sales_by_source,
        "bi_count_products": bi_count_products,
        "bi_default_measures": bi_default_measures,
        "bi_total_sales_header_grain": bi_total_sales_header_grain,
        "bi_day_filter": bi_day_filter,
        "bi_day_filter_all": bi_day_filter_all,
        "bi_day_filter_stored": bi_day_filter_stored,
        "bi_day_filter_frame": bi_day_filter_frame,
        "bi_captions": bi_captions,
        "bi_dashboard_filtered": bi_dashboard_filtered,
        "bi_dashboard_cube": bi_dashboard_cube,
        "bi_cube_kpis": bi_cube_kpis,
        "bi_cube_performance": bi_cube_performance,
    }


# --- the same results in SQL --------------------------------------------------------

_SALES = """
sales AS (
  SELECT cast(o_orderkey AS varchar) AS transaction_id, o_orderpriority AS source,
         c_name AS customer_name, n_name AS delivery_address,
         concat('+63', lpad(cast(c_custkey AS varchar), 10, '0')) AS customer_contact,
         cast(c_custkey % 80 AS int) AS customer_age,
         nullif(o_orderstatus, 'P') AS customer_gender,
         cast(o_totalprice AS decimal(10,2)) AS total_amount,
         c_mktsegment AS payment_type, o_orderdate AS transaction_date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""
_ITEMS = """
items AS (
  SELECT concat(cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar)) AS item_id,
         cast(l_orderkey AS varchar) AS transaction_id, p_name AS product_name,
         cast(p_retailprice AS decimal(10,2)) AS price, cast(l_quantity AS int) AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""
_FULL = f"""{_SALES},{_ITEMS},
sales_full AS (
  SELECT s.transaction_id, s.source, sha256(s.customer_name) AS customer_name,
         'XXX' AS delivery_address, concat(substr(s.customer_contact, 1, 1), '*****') AS customer_contact,
         s.customer_age, s.customer_gender, s.total_amount, s.payment_type, s.transaction_date,
         i.item_id, i.product_name, i.price, i.quantity
  FROM sales s JOIN items i ON s.transaction_id = i.transaction_id
)"""
_REQUESTS = """
requests AS (SELECT DISTINCT cast(event_id * 2 AS varchar) AS transaction_id FROM events)"""
_SENT = f"""{_SALES},{_ITEMS},
sent AS (
  SELECT *, cast(transaction_id AS bigint) AS k,
         CASE WHEN cast(transaction_id AS bigint) % 2 = 1 THEN 'Orange App' ELSE 'Blue App' END AS channel,
         CASE WHEN cast(transaction_id AS bigint) % 2 = 0 AND customer_age % 10 = 3 THEN NULL
              ELSE customer_age END AS known_age
  FROM sales
),
sent_headers AS (
  SELECT transaction_id, channel AS source, customer_name, delivery_address, customer_contact,
         known_age AS customer_age, customer_gender, total_amount, payment_type, transaction_date
  FROM sent
),
sent_items AS (SELECT items.* FROM items JOIN sales USING (transaction_id)),
sent_counts AS (SELECT transaction_id, count(*) AS lines FROM sent_items GROUP BY transaction_id)"""
_ITEM_TEXT = """string_agg(
           concat('{"itemId":"', item_id, '","name":"', product_name, '","price":',
                  cast(price AS varchar), ',"quantity":', cast(quantity AS varchar), '}'),
           ',' ORDER BY item_id, product_name, price, quantity) AS items"""
_ARRAYS = f"""
arrays AS (SELECT transaction_id, {_ITEM_TEXT} FROM items GROUP BY transaction_id)"""
_PART_ARRAYS = f"""
dealt AS (
  SELECT *, ('0x' || substr(sha256(concat(item_id, '|', product_name, '|', cast(price AS varchar),
                '|', cast(quantity AS varchar))), 1, 8))::BIGINT % 4 AS part FROM items),
arrays AS (SELECT transaction_id, part, {_ITEM_TEXT} FROM dealt GROUP BY transaction_id, part)"""


def _quoted(column: str) -> str:
    return f"""coalesce('"' || {column} || '"', 'null')"""


_DOCUMENT = (
    "concat('{\"transactionId\":', " + _quoted("h.transaction_id")
    + ", ',\"source\":', " + _quoted("h.source")
    + ", ',\"customerName\":', " + _quoted("h.customer_name")
    + ", ',\"deliveryAddress\":', " + _quoted("h.delivery_address")
    + ", ',\"customerAge\":', coalesce(cast(h.customer_age AS varchar), 'null')"
    + ", ',\"customerGender\":', " + _quoted("h.customer_gender")
    + ", ',\"customerContact\":', " + _quoted("h.customer_contact")
    + ", ',\"items\":[', coalesce(a.items, ''), ']'"
    + ", ',\"totalAmount\":', coalesce(cast(h.total_amount AS varchar), 'null')"
    + ", ',\"paymentType\":', " + _quoted("h.payment_type")
    + ", ',\"transactionDate\":', " + _quoted("strftime(h.transaction_date, '%Y-%m-%dT%H:%M:%S')")
    + ", '}')"
)

_DAYS = ", ".join(f"DATE '{day}'" for day in SELECTED_DAYS)
_TOP = f"""
            WITH {_SALES},{_ITEMS}
            SELECT product_name, cast(sum(quantity) AS bigint) AS total_sold,
                   cast(sum(price * quantity) AS decimal(38,2)) AS total_revenue
            FROM items JOIN sales USING (transaction_id)
            GROUP BY product_name ORDER BY total_sold DESC NULLS FIRST, product_name"""
_TREND = f"""
            WITH {_SALES}
            SELECT cast(date_trunc('month', transaction_date) AS timestamp) AS month,
                   cast(sum(total_amount) AS decimal(38,2)) AS monthly_sales
            FROM sales GROUP BY 1 ORDER BY 1"""
_SELECTED = f"""
selected AS (
  SELECT 'all' AS selection, * FROM sales_full
  UNION ALL SELECT 'days', * FROM sales_full WHERE cast(transaction_date AS date) IN ({_DAYS})
  UNION ALL SELECT 'half year', * FROM sales_full
  WHERE cast(transaction_date AS date) BETWEEN DATE '1997-01-01' AND DATE '1997-06-30')"""
_CHOSEN = f"""
            WITH {_FULL}
            SELECT * FROM sales_full WHERE cast(transaction_date AS date) IN ({_DAYS})"""
_KPIS = """cast(sum(quantity) AS bigint) AS quantity, cast(sum(total_amount) AS decimal(38,2)) AS total_sales,
         count(DISTINCT customer_name) AS customers, count(DISTINCT transaction_id) AS transactions"""


def sales_sql() -> dict[str, str]:
    sql = _sales_sql()
    names = [raw["target_table"].split(".")[1] for raw in SQL_MARTS]
    counts = [
        f"SELECT 'dm_sales.{name}' AS table_name, count(*) AS stamped_rows, "
        f"cast(1 AS bigint) AS stamps FROM ({sql[f'dm_{name}']})"
        for name in names
    ]
    over_headers = [table.split(".")[1] for table in marts.HEADER_GROUPS]
    return (
        sql
        | {f"dm_sql_{name}": sql[f"dm_{name}"] for name in names}
        | {f"dm_shared_{name}": sql[f"dm_{name}"] for name in over_headers}
        | {"stream_intake_merged": sql["payload_documents"]}
        | {"bi_dashboard_cube": sql["bi_dashboard_filtered"]}
        | {"dm_stamps": " UNION ALL ".join(counts)}
    )


def _sales_sql() -> dict[str, str]:
    return {
        "scan_table": "SELECT * FROM lineitem",
        "scan_query": """
            SELECT c_mktsegment AS segment, count(o_orderkey) AS transactions,
                   cast(sum(cast(o_totalprice AS decimal(10,2))) AS decimal(38,2)) AS total_sales
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
        "sale_header_lookup": f"""
            WITH {_SALES},{_REQUESTS}
            SELECT * FROM sales WHERE transaction_id IN (SELECT transaction_id FROM requests)""",
        "sale_items_lookup": f"""
            WITH {_ITEMS},{_REQUESTS}
            SELECT transaction_id, item_id, product_name, price, quantity FROM items
            WHERE transaction_id IN (SELECT transaction_id FROM requests)""",
        "sale_document": f"""
            WITH {_SALES},{_ITEMS},{_ARRAYS}
            SELECT h.transaction_id AS "transactionId", 0 AS part, {_DOCUMENT} AS document
            FROM sales h LEFT JOIN arrays a ON h.transaction_id = a.transaction_id""",
        "sale_document_parts": f"""
            WITH {_SALES},{_ITEMS},{_PART_ARRAYS}
            SELECT h.transaction_id AS "transactionId", cast(coalesce(part, 0) AS int) AS part,
                   {_DOCUMENT} AS document
            FROM sales h LEFT JOIN arrays a ON h.transaction_id = a.transaction_id""",
        "sale_document_requested": f"""
            WITH {_SALES},{_ITEMS},{_ARRAYS},{_REQUESTS}
            SELECT r.transaction_id AS requested_id, 0 AS part, {_DOCUMENT} AS document
            FROM requests r LEFT JOIN sales h ON h.transaction_id = r.transaction_id
            LEFT JOIN arrays a ON a.transaction_id = r.transaction_id""",
        "payload_parse": f"""
            WITH {_SENT}
            SELECT CASE WHEN k % 2 = 1 THEN transaction_id END AS transaction_id,
                   CASE WHEN k % 2 = 0 THEN transaction_id END AS sales_id,
                   CASE WHEN k % 2 = 1 THEN customer_name END AS nested_name,
                   CASE WHEN k % 2 = 0 THEN customer_name END AS flat_name,
                   CASE WHEN k % 2 = 1 THEN NULL WHEN known_age IS NULL THEN 'n/a'
                        ELSE cast(known_age AS varchar) END AS flat_age,
                   CASE WHEN k % 2 = 1 THEN total_amount END AS total,
                   CASE WHEN k % 2 = 0 THEN total_amount END AS amount_due,
                   cast(CASE WHEN k % 2 = 1 THEN coalesce(lines, 0) ELSE 0 END AS int) AS nested_lines,
                   cast(CASE WHEN k % 2 = 0 THEN coalesce(lines, 0) ELSE 0 END AS int) AS flat_lines
            FROM sent LEFT JOIN sent_counts USING (transaction_id)""",
        "payload_normalize": f"""
            WITH {_SENT}
            SELECT h.*, cast(coalesce(lines, 0) AS int) AS item_count
            FROM sent_headers h LEFT JOIN sent_counts c ON h.transaction_id = c.transaction_id""",
        "payload_to_sales": f"WITH {_SENT} SELECT * FROM sent_headers",
        "payload_to_items": f"WITH {_SENT} SELECT * FROM sent_items",
        "payload_documents": f"""
            WITH {_SENT},{_ARRAYS}
            SELECT h.transaction_id AS "transactionId", {_DOCUMENT} AS document
            FROM sent_headers h LEFT JOIN arrays a ON h.transaction_id = a.transaction_id""",
        "payload_ack": f"""
            WITH {_SENT}
            SELECT 'Success' AS status, 'Record created successfully.' AS message,
                   transaction_id AS "transactionId" FROM sent""",
        "payload_ack_stamp": """
            SELECT 'acknowledgments' AS table_name, count(*) AS stamped_rows,
                   cast(1 AS bigint) AS stamps FROM orders""",
        "payload_rejects": f"""
            WITH {_SENT}
            SELECT CASE k % 3 WHEN 0 THEN 'malformed document' WHEN 1 THEN 'no sale id'
                   ELSE 'no valid date' END AS reject_reason, count(*) AS payloads
            FROM sent GROUP BY 1""",
        "stream_payload_intake": f"""
            WITH {_SENT}
            SELECT h.*, l.item_count, l.item_total, cast(1 AS bigint) AS superseded
            FROM sent_headers h LEFT JOIN (
              SELECT transaction_id, count(*) AS item_count,
                     cast(sum(price * quantity) AS decimal(38,2)) AS item_total
              FROM sent_items GROUP BY transaction_id) l ON h.transaction_id = l.transaction_id""",
        "ingest_full": "SELECT * FROM orders",
        "ingest_stamp": """
            SELECT 'staging.orders' AS table_name, count(*) AS stamped_rows, cast(1 AS bigint) AS stamps
            FROM orders""",
        "ingest_append": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
        "ingest_projection": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
        "ingest_delta": "SELECT * FROM events",
        "ingest_delta_empty_target": "SELECT * FROM events",
        "ingest_delta_null_key": "SELECT * FROM events WHERE event_type <> 'error'",
        "ingest_delta_ties": "SELECT *, cast(ts AS date) AS day FROM events",
        "ingest_reconcile": """
            SELECT 'ingest' AS job, t AS table_name, 'DONE' AS status, n AS rows_in, n AS rows_out,
                   concat('full load, overwrite, source ', n, ', target ', n) AS message
            FROM (SELECT 'orders' AS t, count(*) AS n FROM orders
                  UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
            UNION ALL SELECT 'ingest', 'nowhere', 'SKIPPED', NULL, NULL, 'no configuration'""",
        "run_audit": f"""
            WITH {_FULL}
            SELECT job, table_name, 'DONE' AS status, rows_out,
                   CASE WHEN job = 'export' THEN replace(table_name, '.', '_') END AS folder
            FROM (VALUES ('datamart'), ('export')) AS jobs(job), (
              SELECT 'dm_sales.top_selling_products' AS table_name,
                     count(DISTINCT product_name) AS rows_out FROM sales_full
              UNION ALL SELECT 'dm_sales.sales_by_source', count(DISTINCT source) FROM sales
              UNION ALL SELECT 'dm_sales.customer_demographics', count(*) FROM (
                SELECT DISTINCT customer_gender, customer_age // 10, customer_name, delivery_address,
                       customer_contact FROM sales)
              UNION ALL SELECT 'dm_sales.sales_trend',
                     count(DISTINCT date_trunc('month', transaction_date)) FROM sales
              UNION ALL SELECT 'dm_sales.sales_full', count(*) FROM sales_full)""",
        "log_report": """
            WITH steps AS (
              SELECT concat('dm_sales.', event_type, '_', user_id) AS table_name,
                     date_trunc('second', ts) AS started,
                     date_trunc('second', ts + to_seconds(cast(event_id % 7 AS int))) AS ended,
                     event_id AS rows
              FROM events),
            ticks AS (
              SELECT table_name, tick, max(started) OVER (PARTITION BY table_name ORDER BY tick
                     RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS started_at
              FROM (SELECT table_name, started AS tick, started FROM steps
                    UNION ALL SELECT table_name, ended, NULL FROM steps))
            SELECT 'datamart' AS job, s.table_name, t.started_at, s.ended AS ended_at,
                   date_diff('second', t.started_at, s.ended) AS seconds, s.rows
            FROM steps s JOIN (SELECT DISTINCT * FROM ticks) t
              ON s.table_name = t.table_name AND s.ended = t.tick""",
        "mask_hash": f"""
            WITH {_SALES}
            SELECT transaction_id, sha256(customer_name) AS customer_name,
                   sha256(cast(customer_age AS varchar)) AS customer_age FROM sales""",
        "mask_fixed": f"""
            WITH {_SALES}
            SELECT transaction_id, 'XXX' AS delivery_address, 'XXX' AS customer_gender FROM sales""",
        "mask_partial": f"""
            WITH {_SALES}
            SELECT transaction_id, substr(customer_contact, 1, 1) || '*****' AS customer_contact,
                   substr(customer_gender, 1, 1) || '*****' AS customer_gender,
                   substr(cast(total_amount AS varchar), 1, 1) || '*****' AS total_amount FROM sales""",
        "mask_dispatch": f"""
            WITH {_SALES}
            SELECT transaction_id, source, sha256(customer_name) AS customer_name,
                   'XXX' AS delivery_address, substr(customer_contact, 1, 1) || '*****' AS customer_contact,
                   customer_age, customer_gender, total_amount, payment_type FROM sales""",
        "dm_top_selling_products": _TOP,
        "dm_top_selling_products_semi": _TOP,
        "dm_sales_by_source": f"""
            WITH {_SALES}
            SELECT source, cast(sum(total_amount) AS decimal(38,2)) AS total_sales,
                   count(transaction_id) AS transactions FROM sales GROUP BY source""",
        "dm_customer_demographics": f"""
            WITH {_SALES}
            SELECT customer_gender, cast(customer_age // 10 AS double) * 10 AS age_group,
                   count(*) AS count_customers, cast(sum(total_amount) AS decimal(38,2)) AS total_spent,
                   sha256(customer_name) AS customer_name, 'XXX' AS delivery_address,
                   substr(customer_contact, 1, 1) || '*****' AS customer_contact
            FROM sales
            GROUP BY customer_gender, age_group, sales.customer_name, sales.delivery_address,
                     sales.customer_contact""",
        "dm_sales_trend": _TREND,
        "dm_sales_full": f"WITH {_FULL} SELECT * FROM sales_full",
        "export_csv_roundtrip": f"WITH {_FULL} SELECT * FROM sales_full",
        "scan_split_sizes": """
            SELECT count(*) AS line_count, cast(0 AS bigint) AS in_no_part,
                   cast(0 AS bigint) AS in_two_parts, true AS near_equal FROM lineitem""",
        "ingest_delta_current": """
            SELECT * REPLACE (
              CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 2 WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1
                   ELSE o_totalprice END AS o_totalprice,
              CASE WHEN o_orderkey % 4 = 0 THEN TIMESTAMP '2030-01-02'
                   WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2030-01-01' ELSE modified END AS modified)
            FROM (SELECT * RENAME (o_orderdate AS modified) FROM orders)""",
        "ingest_reconcile_content": """
            SELECT CASE WHEN o_orderkey % 100 = 4 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey,
              CASE o_orderkey % 100 WHEN 1 THEN 'changed' WHEN 2 THEN 'lost' WHEN 3 THEN 'repeated'
                   ELSE 'foreign' END AS difference,
              CASE WHEN o_orderkey % 100 = 4 THEN 0 ELSE 1 END::BIGINT AS source_rows,
              CASE o_orderkey % 100 WHEN 2 THEN 0 WHEN 3 THEN 2 ELSE 1 END::BIGINT AS target_rows
            FROM orders WHERE o_orderkey % 100 BETWEEN 1 AND 4""",
        "dm_top_selling_products_positions": f"""
            SELECT *, row_number() OVER (ORDER BY total_sold DESC NULLS FIRST, product_name) AS position
            FROM ({_TOP})""",
        "dm_sales_trend_positions": f"""
            SELECT *, row_number() OVER (ORDER BY month NULLS LAST) AS position FROM ({_TREND})""",
        "dm_top_products": f"{_TOP} LIMIT 10",
        "dm_top_products_by_source": f"""
            WITH {_SALES}, {_ITEMS}, sold AS (
              SELECT source, product_name, cast(sum(quantity) AS bigint) AS total_sold
              FROM items JOIN sales USING (transaction_id) GROUP BY source, product_name)
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source
                ORDER BY total_sold DESC NULLS FIRST, product_name)::INT AS rank FROM sold)
            WHERE rank <= 3""",
        "export_ordered_lines": f"""
            SELECT 'dm_sales.top_selling_products' AS export,
              row_number() OVER (ORDER BY total_sold DESC NULLS FIRST, product_name) AS position,
              concat_ws(',', product_name, cast(total_sold AS varchar),
                cast(cast(total_revenue AS decimal(38,18)) AS varchar)) AS line FROM ({_TOP})
            UNION ALL SELECT 'dm_sales.sales_trend', row_number() OVER (ORDER BY month),
              concat_ws(',', strftime(month, '%Y-%m-%dT%H:%M:%S.%g'),
                cast(cast(monthly_sales AS decimal(38,18)) AS varchar)) FROM ({_TREND})""",
        "export_csv_dialect": r"""
            SELECT row_number() OVER (ORDER BY p_partkey) AS position,
              p_partkey || ',' || CASE p_partkey % 7
                WHEN 1 THEN '"say \"' || p_name || '\""' WHEN 2 THEN '"' || p_name || ', vol. 2"'
                WHEN 3 THEN '""' WHEN 4 THEN '"\""' WHEN 6 THEN '' ELSE p_name END
              || ',' || p_partkey % 7 AS line FROM part""",
        "bi_cube_kpis": f"""
            WITH {_FULL}, {_SELECTED}
            SELECT selection, {_KPIS} FROM selected GROUP BY selection""",
        "bi_cube_performance": f"""
            WITH {_FULL}, {_SELECTED}
            SELECT selection, product_name, source, {_KPIS} FROM selected GROUP BY ALL""",
        "bi_product_performance_positions": f"""
            WITH {_FULL}, cells AS (
              SELECT product_name, source, {_KPIS} FROM sales_full GROUP BY product_name, source),
            totals AS (SELECT *, sum(total_sales) OVER (PARTITION BY product_name) AS of_product FROM cells)
            SELECT * EXCLUDE (of_product), row_number() OVER (
              ORDER BY of_product DESC NULLS LAST, product_name, source) AS position FROM totals""",
        "export_csv_lines": f"""
            WITH {_FULL}, by_source AS (
              SELECT source, cast(sum(total_amount) AS decimal(38,18)) AS total_sales,
                     count(transaction_id) AS transactions FROM sales GROUP BY source)
            SELECT 'sales_by_source' AS export, 'source,total_sales,transactions' AS line
            UNION ALL SELECT 'sales_by_source', concat_ws(',', source, cast(total_sales AS varchar),
                cast(transactions AS varchar)) FROM by_source
            UNION ALL SELECT 'sales_full', '{','.join(SALES_FULL_COLUMNS)}'
            UNION ALL SELECT 'sales_full', concat_ws(',', transaction_id, source, customer_name,
                delivery_address, customer_contact, cast(customer_age AS varchar),
                coalesce(customer_gender, ''), cast(total_amount AS varchar), payment_type,
                strftime(transaction_date, '%Y-%m-%dT%H:%M:%S.%g'), item_id, product_name,
                cast(price AS varchar), cast(quantity AS varchar)) FROM sales_full""",
        "bi_kpis": f"WITH {_FULL} SELECT {_KPIS} FROM sales_full",
        "bi_kpis_long": f"""
            WITH {_FULL}, wide AS (SELECT {_KPIS} FROM sales_full)
            SELECT 1 AS position, '# of Items' AS measure, cast(quantity AS decimal(38,2)) AS value FROM wide
            UNION ALL SELECT 2, 'Total Sales', total_sales FROM wide
            UNION ALL SELECT 3, '# of Customers', customers FROM wide
            UNION ALL SELECT 4, '# of Transactions', transactions FROM wide""",
        "bi_product_performance": f"""
            WITH {_FULL}
            SELECT product_name, source, {_KPIS} FROM sales_full GROUP BY product_name, source""",
        "bi_quantity_per_product": f"""
            WITH {_FULL}
            SELECT product_name, cast(sum(quantity) AS bigint) AS quantity
            FROM sales_full GROUP BY product_name ORDER BY product_name""",
        "bi_sales_over_time": f"""
            WITH {_FULL}
            SELECT cast(date_trunc('day', transaction_date) AS timestamp) AS day,
                   cast(sum(price) AS decimal(38,2)) AS total_price
            FROM sales_full GROUP BY 1 ORDER BY 1""",
        "bi_sales_by_source": f"""
            WITH {_FULL}, slices AS (
              SELECT source, cast(sum(total_amount) AS decimal(38,2)) AS total_sales,
                     cast(sum(quantity) AS bigint) AS quantity FROM sales_full GROUP BY source)
            SELECT *, cast(total_sales AS double) / cast(sum(total_sales) OVER () AS double) AS share
            FROM slices""",
        "bi_count_products": f"WITH {_FULL} SELECT count(item_id) AS count_products FROM sales_full",
        "bi_default_measures": f"""
            WITH {_FULL}
            SELECT cast(year(transaction_date) AS int) AS year_transaction_date,
                   count(transaction_id) AS count_transaction_id, count(source) AS count_source,
                   count(customer_name) AS count_customer_name,
                   count(delivery_address) AS count_delivery_address,
                   count(customer_contact) AS count_customer_contact,
                   cast(sum(customer_age) AS bigint) AS sum_customer_age,
                   count(customer_gender) AS count_customer_gender,
                   cast(sum(total_amount) AS decimal(38,2)) AS sum_total_amount,
                   count(payment_type) AS count_payment_type, count(item_id) AS count_item_id,
                   count(product_name) AS count_product_name,
                   cast(sum(price) AS decimal(38,2)) AS sum_price,
                   cast(sum(quantity) AS bigint) AS sum_quantity
            FROM sales_full GROUP BY 1""",
        "bi_total_sales_header_grain": f"""
            WITH {_SALES}
            SELECT cast(sum(total_amount) AS decimal(38,2)) AS total_sales FROM sales""",
        "bi_day_filter": _CHOSEN,
        "bi_day_filter_stored": _CHOSEN,
        "bi_day_filter_frame": f"""
            WITH {_FULL}
            SELECT * FROM sales_full WHERE cast(transaction_date AS date) IN (
              SELECT make_date(1996, month(ts), day(ts)) FROM events WHERE event_type = 'error')""",
        "bi_captions": f"""
            WITH {_FULL}, cells AS (
              SELECT product_name, source, {_KPIS} FROM sales_full GROUP BY product_name, source)
            SELECT product_name AS "Product Name", source AS "Source", total_sales AS "Total Sales",
                   quantity AS "# of Items", customers AS "# of Customers",
                   transactions AS "# of Transactions" FROM cells""",
        "bi_day_filter_all": f"WITH {_FULL} SELECT * FROM sales_full",
        "bi_dashboard_filtered": f"""
            WITH {_FULL},
            chosen AS (SELECT * FROM sales_full WHERE cast(transaction_date AS date) IN ({_DAYS})),
            cells AS (
              SELECT 'KPIs' AS sheet, '' AS label, {_KPIS} FROM chosen
              UNION ALL SELECT 'Product Performance', product_name || ' / ' || source, {_KPIS}
              FROM chosen GROUP BY product_name, source),
            long AS (
              SELECT sheet, label, 'quantity' AS measure, cast(quantity AS decimal(38,2)) AS value FROM cells
              UNION ALL SELECT sheet, label, 'total_sales', total_sales FROM cells
              UNION ALL SELECT sheet, label, 'customers', customers FROM cells
              UNION ALL SELECT sheet, label, 'transactions', transactions FROM cells
              UNION ALL SELECT 'Quantity Sold per Product', product_name, 'quantity', sum(quantity)
              FROM chosen GROUP BY product_name
              UNION ALL SELECT 'Sales by Source', source, 'quantity', sum(quantity)
              FROM chosen GROUP BY source
              UNION ALL SELECT 'Sales by Source', source, 'total_sales', sum(total_amount)
              FROM chosen GROUP BY source
              UNION ALL SELECT 'Sales Trend', strftime(transaction_date, '%Y-%m-%d 00:00:00'),
                     'total_price', sum(price) FROM sales_full GROUP BY 2)
            SELECT sheet, label, measure, cast(value AS decimal(38,2)) AS value FROM long""",
    }
