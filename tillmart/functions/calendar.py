"""Calendar truncation on wall-clock timestamps, independent of the session zone.

`date_trunc` on a timestamp without zone goes through the session zone, so these
go through DATE, which has no zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(column: Column) -> Column:
    return F.trunc(column, "month").cast("timestamp_ntz")


def day_start(column: Column) -> Column:
    return column.cast("date").cast("timestamp_ntz")


def wall_clock(text: Column) -> Column:
    """Date-time text as wall-clock time in whole seconds; an offset is dropped.

    Text that is no date-time gives null.
    """
    parsed = text.try_cast("timestamp_ntz")
    fraction = F.date_part(F.lit("second"), parsed) % 1
    return parsed - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)


def iso_text(column: Column) -> Column:
    """Wall-clock time as `yyyy-MM-ddTHH:mm:ss`."""
    return F.translate(F.left(column.cast("string"), F.lit(19)), " ", "T")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from one wall-clock time to another."""
    return (end - start).cast("interval second").cast("long")


def age_band(age: Column) -> Column:
    """Lower edge of the ten-year band of an integer age, truncating toward zero."""
    return (age - age % 10).cast("double")
