"""Keep the rows of selected calendar days."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.functions.calendar import day_start, month_start
from tillmart.sources.scratch import scratch_dir

MONTH_COLUMN = "sale_month"

Days = Iterable[date] | DataFrame | None


def _as_date(day: date) -> date:
    return day.date() if isinstance(day, datetime) else day


def _midnight(day: date) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def on_days(df: DataFrame, days: Days, column: str = "transaction_date") -> DataFrame:
    """Rows whose day is selected; None means no selection and keeps every row.

    A list becomes the span of its days on the raw column, which reaches the scan, and the
    list of days itself; on a table stored by month, a list of months prunes its partitions.
    A DataFrame of days (first column) is reduced to its days at once and becomes a semi-join,
    on such a table also on the month, so that partitions are pruned when it runs.
    """
    if days is None:
        return df
    by_month = MONTH_COLUMN in df.columns
    if isinstance(days, DataFrame):
        day = day_start(F.col(days.columns[0]))
        # Both bounds hold for any day; a filter on the days is what lets Spark prune by them.
        first, last = (F.lit(text).cast("timestamp_ntz") for text in ("0001-01-01", "9999-12-31"))
        chosen = days.select(day.alias("_day")).filter(F.col("_day").between(first, last))
        keyed = df.withColumn("_day", day_start(F.col(column)))
        keys = ["_day"]
        if by_month:
            chosen = with_month(chosen, "_day")
            keys.append(MONTH_COLUMN)
        # Stored, the days have a known size, and few are joined without a shuffle of the rows.
        folder = f"{scratch_dir(df.sparkSession, 'days')}/rows"
        chosen.distinct().write.parquet(folder)
        stored = df.sparkSession.read.schema(chosen.schema).parquet(folder)
        stored = stored.filter(F.col("_day").between(first, last))
        return keyed.join(stored, keys, "left_semi").select(df.columns)
    chosen = sorted({_as_date(day) for day in days})
    if not chosen:
        return df.filter(F.lit(False))
    when = F.col(column)
    following = chosen[-1] + timedelta(days=1)
    kept = df.filter((when >= _midnight(chosen[0])) & (when < _midnight(following)))
    kept = kept.filter(when.cast("date").isin(chosen))
    if by_month:
        months = sorted({date(day.year, day.month, 1) for day in chosen})
        kept = kept.filter(F.col(MONTH_COLUMN).isin(months))
    return kept


def with_month(df: DataFrame, column: str = "transaction_date") -> DataFrame:
    """Add the month a table is stored by."""
    return df.withColumn(MONTH_COLUMN, month_start(F.col(column)).cast("date"))
