"""Cutting a scan into parts of near equal size along a key, however its values are spread."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ranks may be wrong by this share of a part.
RANK_SHARE = 0.01
# A part of one value that is larger than this share of an even part is cut once more.
TOO_LARGE = 1.5


@dataclass(frozen=True)
class EquiDepth:
    """A wish for parts of equal size along `column`; a value that fills more than a part is
    cut along `within`, if that is given."""

    column: str
    parts: int
    within: str | None = None


@dataclass(frozen=True)
class KeyRange:
    """Rows with lower <= column < upper; an end that is None is open.

    `nulls` adds rows without a value. `inside` narrows the rows by a range of another column.
    """

    column: str
    lower: Any = None
    upper: Any = None
    nulls: bool = False
    inside: KeyRange | None = None

    def where(self) -> Column:
        """The condition for rows in Spark."""
        value = F.col(f"`{self.column}`")
        held = F.lit(True)
        if self.lower is not None:
            held = held & (value >= F.lit(self.lower))
        if self.upper is not None:
            held = held & (value < F.lit(self.upper))
        held = (value.isNull() | held) if self.nulls else (value.isNotNull() & held)
        return held & self.inside.where() if self.inside else held

    def sql(self) -> str:
        """The condition as SQL text for a database."""
        ends = [f"{self.column} >= {literal(self.lower)}"] if self.lower is not None else []
        if self.upper is not None:
            ends.append(f"{self.column} < {literal(self.upper)}")
        if self.nulls:
            held = f"({self.column} IS NULL OR {' AND '.join(ends)})" if ends else "1 = 1"
        else:
            held = " AND ".join(ends) if ends else f"{self.column} IS NOT NULL"
        return f"{held} AND {self.inside.sql()}" if self.inside else held


def literal(value: Any) -> str:
    """A value as standard SQL writes it."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no bound of a range: {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.replace(tzinfo=None).isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def ranges_of(column: str, bounds: Sequence[Any]) -> list[KeyRange]:
    """The ranges that begin at the bounds: disjoint, and together all rows.

    Bounds that are null or repeated make no range. Rows without a value go with the first.
    """
    inner = sorted({b for b in bounds if b is not None})[1:]
    ends = [None, *inner, None]
    return [KeyRange(column, a, b, nulls=a is None) for a, b in zip(ends[:-1], ends[1:])]


def bounds_sql(table: str, column: str, parts: int) -> str:
    """A statement with which a database finds the first value of each of so many equal parts."""
    return (
        f"SELECT MIN({column}) AS bound FROM (SELECT {column}, NTILE({parts}) OVER "
        f"(ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL) AS tiles "
        "GROUP BY part ORDER BY bound"
    )


def _bounds(df: DataFrame, column: str, parts: int) -> list[Any]:
    """First values of equal parts.

    Numbers and times go through a quantile summary that tasks hand over; other types are dealt
    to ranges by a sample, of which only the first values come to the driver.
    """
    value = F.col(f"`{column}`")
    kind = df.schema[column].dataType
    given = df.filter(value.isNotNull()).select(value.alias("value"))
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType)):
        shares = [F.lit(n / parts) for n in range(parts)]
        accuracy = F.lit(int(parts / RANK_SHARE))
        quantiles = given.agg(F.percentile_approx("value", F.array(*shares), accuracy).alias("q"))
        return quantiles.first()["q"] or []
    dealt = given.repartitionByRange(parts, "value")
    firsts = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min("value").alias("first"))
    return [row["first"] for row in firsts.collect()]


def equi_depth(df: DataFrame, wanted: EquiDepth) -> list[KeyRange]:
    """Ranges of a key that hold nearly equally many rows each.

    A value that many rows share cannot be cut along its own column. Where such a range is too
    large, it is cut along `within`. Rows are counted per range in one aggregation; only bounds
    and counts come to the driver.
    """
    ranges = ranges_of(wanted.column, _bounds(df, wanted.column, wanted.parts))
    if wanted.within is None:
        return ranges
    counts = df.agg(*[F.count_if(r.where()).alias(f"n{i}") for i, r in enumerate(ranges)]).first()
    even = max(1, sum(counts) / wanted.parts)
    cut: list[KeyRange] = []
    for held, count in zip(ranges, counts):
        if count <= TOO_LARGE * even:
            cut.append(held)
            continue
        bounds = _bounds(df.filter(held.where()), wanted.within, -(-count // int(even)))
        cut += [
            KeyRange(held.column, held.lower, held.upper, held.nulls, inside)
            for inside in ranges_of(wanted.within, bounds)
        ]
    return cut


def part_sizes(df: DataFrame, ranges: Sequence[KeyRange]) -> DataFrame:
    """part, rows: how many rows each range holds; rows of no or of two ranges show as well.

    `part` is the number of the range, from 0; -1 for rows in none, and -2 for rows in several.
    """
    hits = F.array(*[F.when(r.where(), F.lit(n)) for n, r in enumerate(ranges)])
    met = F.filter(hits, lambda n: n.isNotNull())
    part = F.when(F.size(met) == 0, -1).when(F.size(met) > 1, -2).otherwise(F.get(met, F.lit(0)))
    return df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
