"""Comparing two tables by content, with the rows read once where they agree.

Rows are dealt to buckets by a hash of their key; each bucket's rows are counted and the hashes
of their contents summed, which does not depend on order. Only buckets that differ are compared
key by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.operators.versions import row_digest

BUCKETS = 4096
LOST, FOREIGN, CHANGED, REPEATED = "lost", "foreign", "changed", "repeated"


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(row_digest(key), F.lit(buckets)).cast("int")


def _contents(columns: Sequence[str]) -> list[Column]:
    """Order-free sums of two hashes of a row, as decimals that do not overflow."""
    return [
        F.sum(row_digest(columns, seed).cast("decimal(38,0)")).alias(f"_sum{seed}") for seed in (1, 2)
    ]


def bucket_sums(df: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    return df.groupBy(_bucket(key, buckets).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_rows"), *_contents(columns)
    )


def differing_buckets(
    source: DataFrame, target: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS
) -> list[int]:
    """Buckets whose rows are not the same on both sides; at most `buckets` numbers."""
    sides = [bucket_sums(df, key, columns, buckets) for df in (source, target)]
    told = sides[0].unionByName(sides[1])
    # Equal sides give the same row twice.
    odd = told.groupBy(*told.columns).agg(F.count(F.lit(1)).alias("_sides")).filter("_sides = 1")
    return sorted(row[0] for row in odd.select("_bucket").distinct().collect())


def differences(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The key, difference, source_rows and target_rows of every key that differs.

    `lost` keys are not in the target, `foreign` ones not in the source; `repeated` ones are in
    both, but not as often; `changed` ones have other contents in as many rows. `columns` are
    compared, without them all of the source. The columns must be of one type on both sides. A
    null is a value like another. Rows of buckets that agree are read once and not shuffled.
    """
    compared = list(columns or source.columns)
    wanted = [f"`{c}`" for c in dict.fromkeys([*key, *compared])]
    source, target = source.select(*wanted), target.select(*wanted)
    kinds = {c: (source.schema[c].dataType, target.schema[c].dataType) for c in compared}
    other = [c for c, (a, b) in kinds.items() if a != b]
    if other:
        raise ValueError(f"columns of another type in the target: {', '.join(other)}")
    odd = differing_buckets(source, target, key, compared, buckets)

    def told(df: DataFrame, side: str) -> DataFrame:
        held = df.filter(_bucket(key, buckets).isin(odd)) if odd else df.limit(0)
        one, two = (F.lit(1), F.lit(0)) if side == "source" else (F.lit(0), F.lit(1))
        return held.select(
            *[F.col(f"`{c}`") for c in key], one.alias("_s"), two.alias("_t"),
            *[
                (row_digest(compared, seed).cast("decimal(38,0)") * (one - two)).alias(f"_d{seed}")
                for seed in (1, 2)
            ],
        )

    both = told(source, "source").unionByName(told(target, "target"))
    summed = both.groupBy(*[F.col(f"`{c}`") for c in key]).agg(
        F.sum("_s").alias("source_rows"), F.sum("_t").alias("target_rows"),
        F.sum("_d1").alias("_d1"), F.sum("_d2").alias("_d2"),
    )
    kind = (
        F.when(F.col("target_rows") == 0, LOST)
        .when(F.col("source_rows") == 0, FOREIGN)
        .when(F.col("source_rows") != F.col("target_rows"), REPEATED)
        .when((F.col("_d1") != 0) | (F.col("_d2") != 0), CHANGED)
    )
    found = summed.withColumn("difference", kind).filter("difference IS NOT NULL")
    return found.select(*[F.col(f"`{c}`") for c in key], "difference", "source_rows", "target_rows")
