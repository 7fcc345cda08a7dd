"""Current rows of a table to which updates were appended as new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_digest(columns: Sequence[str], seed: int = 42) -> Column:
    """A hash of a row in which a null is told from every value and from its place."""
    parts = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(F.lit(seed), *parts, *[part.isNull() for part in parts])


def current_rows(df: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """For each key the row of the largest version.

    `version` names the columns that tell newer rows from older ones, such as the delta column
    and the time of the load; a null is older than any value. Rows alike in these are told
    apart by their content, so every run picks the same one. A null key is a key like another.
    Versions are combined before the shuffle: a key with very many versions costs a row a task.
    """
    missing = [c for c in [*key, *version] if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    rest = [c for c in df.columns if c not in key]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    age = F.struct(*[F.col(f"`{c}`") for c in version], row_digest(df.columns))
    newest = df.groupBy(*[F.col(f"`{c}`") for c in key]).agg(F.max_by(row, age).alias("_newest"))
    return newest.select(
        *[
            F.col(f"`{c}`") if c in key else F.col("_newest").getField(c).alias(c)
            for c in df.columns
        ]
    )
