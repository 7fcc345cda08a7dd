"""High-water-mark filter of an incremental load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def high_water_mark(target: DataFrame, column: str) -> Column | None:
    """Largest loaded value of the delta column, None for an empty target.

    One value comes back to the driver, so that the bound is a literal which reaches
    the source's scan. It travels as text, or as microseconds if it is an instant:
    a Python date-time would be read in the zone of the Python process.
    """
    data_type = target.schema[column].dataType
    instant = isinstance(data_type, T.TimestampType)
    largest = F.max(column)
    sent = F.unix_micros(largest) if instant else largest.cast("string")
    value = target.agg(sent).first()[0]
    if value is None:
        return None
    return F.timestamp_micros(F.lit(value)) if instant else F.lit(value).cast(data_type)


def newer_than(source: DataFrame, column: str, mark: Column | None) -> DataFrame:
    """Rows strictly above the mark; without a mark, every row.

    Rows equal to the mark stay out, and so do rows without a value.
    """
    return source if mark is None else source.filter(F.col(column) > mark)


def not_older_than(
    source: DataFrame, target: DataFrame, column: str, mark: Column | None, key: str
) -> DataFrame:
    """Rows at or above the mark that the target does not hold yet.

    For sources where rows may arrive late with the value of the mark itself. Only
    the part of the target that carries the mark is compared; a null key is a key as
    any other.
    """
    if mark is None:
        return source
    loaded = target.filter(F.col(column) == mark).select(F.col(key).alias("_loaded")).distinct()
    late = source.filter(F.col(column) >= mark)
    return late.join(loaded, late[key].eqNullSafe(loaded["_loaded"]), "left_anti")
