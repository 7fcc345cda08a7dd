"""Row numbers of a whole ordered result, worked out by many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.sources.scratch import scratch_dir

# Row ids of Spark: the number of the partition, then 33 bits for the row in it.
ROW_BITS = 33


def with_positions(
    df: DataFrame, order: Sequence[Column], name: str = "position", partitions: int | None = None
) -> DataFrame:
    """The rows with their place, from 1, in the given order, as `name`.

    Rows are dealt to ranges of the order, sorted range by range, and written with their number
    in the range; the rows of the ranges before are added. Only one count per range is summed in
    a single task. Ties go by the hash of the whole row, which also spreads a value that many
    rows share over several ranges; rows alike in every column stay together. `name` must not
    be a column yet. An empty table gives no rows.
    """
    if name in df.columns:
        raise ValueError(f"{name}: the rows have such a column")
    keys = [*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).asc()]
    dealt = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    numbered = dealt.sortWithinPartitions(*keys).withColumn(
        "_row_id", F.monotonically_increasing_id()
    )
    folder = scratch_dir(df.sparkSession, "positions") + "/rows"
    numbered.write.parquet(folder)
    stored = df.sparkSession.read.schema(numbered.schema).parquet(folder)
    span = F.shiftright("_row_id", ROW_BITS)
    sizes = stored.groupBy(span.alias("_range")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = F.col("_row_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        stored.withColumn("_range", span)
        .join(starts, "_range")
        .withColumn(name, F.col("_start") + within + 1)
        .select(*[F.col(f"`{c}`") for c in df.columns], name)
    )
