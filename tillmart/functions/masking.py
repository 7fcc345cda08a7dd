"""Masks for personal data, chosen per column by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
FIXED_MASK = "XXX"
PARTIAL_TAIL = "*****"


def hashed(column: Column) -> Column:
    """SHA-256 hex of the text form; null stays null."""
    return F.sha2(column.cast("string"), 256)


def fixed(column: Column) -> Column:
    """The same constant for every row, null included."""
    return F.lit(FIXED_MASK)


def partial(column: Column) -> Column:
    """First character, then a fixed tail; null stays null."""
    return F.concat(F.left(column.cast("string"), F.lit(1)), F.lit(PARTIAL_TAIL))


MASKS: dict[str, Callable[[Column], Column]] = {
    "hash": hashed,
    "fixed": fixed,
    "partial": partial,
}


class UnknownMask(ValueError):
    """A configured mask type does not exist, so the column would stay in clear."""


def mask_columns(df: DataFrame, masks: Mapping[str, str]) -> DataFrame:
    """Replace every listed column that is present by its masked form.

    Column names resolve without regard to case, like everywhere in Spark, and
    listed columns that are absent are skipped. An unknown mask type raises: the
    job then fails before anything is written.
    """
    present = {name.lower(): name for name in df.columns}
    masked = {}
    for listed, kind in masks.items():
        name = present.get(listed.lower())
        if name is None:
            continue
        mask = MASKS.get(kind.lower())
        if mask is None:
            raise UnknownMask(f"unknown mask type {kind!r} for column {name!r}")
        masked[name] = mask(F.col(f"`{name}`"))
    return df.withColumns(masked) if masked else df
