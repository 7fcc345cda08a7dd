"""Export of tables to CSV folders."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.operators.positions import with_positions
from tillmart.plans.audit import DONE, FAILED, Run, counted_write, now, summary
from tillmart.plans.marts import MARTS
from tillmart.schemas import WIDE_MONEY
from tillmart.sources.scratch import passing_shuffles
from tillmart.sources.stores import Store, zone_timestamps

SUM_MONEY = T.DecimalType(38, 18)


def folder_name(table: str, at: datetime) -> str:
    return f"{table.replace('.', '_')}_{at:%Y%m%d_%H%M%S}"


def as_exported(df: DataFrame) -> DataFrame:
    """Render columns the way a mart read back from the database is rendered.

    Date-times carry the session's offset and sums of money 18 fractional digits.
    """
    sums = {
        column.name: F.col(f"`{column.name}`").cast(SUM_MONEY)
        for column in df.schema
        if column.dataType == WIDE_MONEY
    }
    return zone_timestamps(df).withColumns(sums) if sums else zone_timestamps(df)


def in_order(df: DataFrame, order: Sequence[Column], files: int | None = None) -> DataFrame:
    """The rows as ranges of the order, each sorted: written, the names of the part files follow
    the order. Adaptive execution joins small neighbouring ranges unless `files` is given."""
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order)


def write_csv(
    df: DataFrame,
    path: str,
    lossless: bool = False,
    order: Sequence[Column] | None = None,
    files: int | None = None,
) -> int:
    """Write a CSV folder with a header line per file, and return the rows written.

    Blanks around values are trimmed unless `lossless`, which also doubles quotes
    inside quotes, so that `read_csv` gets back every value as it was. With an `order`,
    part files read by name hold the rows in it.
    """
    if order:
        df = in_order(df, order, files)
    options = {"header": "true"}
    if lossless:
        options |= {
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
            "escape": '"',
        }

    def write(seen: Observation) -> None:
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").options(**options).csv(path)

    return counted_write(write)


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """position, line: the lines of a text folder in the order of its file names, header lines
    of the files left out."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    placed = with_positions(lines, [F.asc("file"), F.asc("block"), F.asc("place")], "line_number")
    firsts = placed.groupBy("file").agg(F.min("line_number").alias("first"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row for each file.
    headers = firsts.withColumn("headers", F.count(F.lit(1)).over(before))
    return (
        placed.join(headers, "file")
        .filter("line_number > first")
        .select((F.col("line_number") - F.col("headers")).alias("position"), F.col("value").alias("line"))
    )


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False
) -> DataFrame:
    """Read back a lossless export.

    Text with line breaks needs `line_breaks`, which reads each file in one task.
    """
    return (
        spark.read.schema(schema)
        .options(header="true", escape='"', multiLine=line_breaks, mode="FAILFAST")
        .options(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        # What stands for null must differ from quoted empty text.
        .option("nullValue", "\u0000")
        .csv(path)
    )


def run_export(
    spark: SparkSession,
    store: Store,
    tables: Iterable[str],
    output_dir: str,
    audit: tuple[Store, str] | None = None,
    at_once: int = 8,
    orders: Mapping[str, Callable[[], list[Column]]] | None = None,
) -> DataFrame:
    """Export the listed tables, `at_once` of them at a time.

    A table that fails is recorded, and the others go on. Tables are written in the order that
    `orders` names for them, without it in that of the built-in marts.
    """
    if orders is None:
        orders = {mart.target_table: mart.order for mart in MARTS if mart.order}
    run = Run(spark, "export")

    def export(table: str) -> None:
        started = now()
        path = f"{output_dir.rstrip('/')}/{folder_name(table, datetime.now())}"
        try:
            order = orders[table]() if table in orders else None
            written = write_csv(as_exported(store.read(table)), path, order=order)
            run.record(table, DONE, started, rows_in=written, rows_out=written, message=path)
        except Exception as error:
            run.record(table, FAILED, started, message=summary(error))

    with passing_shuffles(spark):
        run.each(export, list(dict.fromkeys(tables)), at_once)
    if audit and run.rows:
        run.save(*audit)
    return run.frame()
