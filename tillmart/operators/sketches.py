"""Bitmaps of key hashes that tell which stored parts cannot hold a key.

The keys of a part are dealt to bitmaps by a hash, some hundreds to each, and every key sets
a few bits of its bitmap. A key whose bits are not all set is certainly not in the part. With
KEYS_PER_BITMAP keys a bitmap is filled to a ninth, and a key that is not there seems to be once
in thirty million.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of one bitmap as Spark's functions make them.
BITS = 32_768
KEYS_PER_BITMAP = 500
BITS_PER_KEY = 8
_PLACE_SEED = 97


@dataclass(frozen=True)
class Sketched:
    """A stored part and how many bitmaps its keys were dealt to."""

    part: str
    bitmaps: int


def bitmaps_for(keys: int) -> int:
    return max(1, -(-keys // KEYS_PER_BITMAP))


def _places(key: Column) -> Column:
    """The bits of a key, at most BITS_PER_KEY different ones."""
    hashes = [F.xxhash64(key, F.lit(_PLACE_SEED + n)) for n in range(BITS_PER_KEY)]
    return F.array(*[F.pmod(h, F.lit(BITS)) for h in hashes])


def _bitmap(key: Column, bitmaps: Column) -> Column:
    return F.pmod(F.xxhash64(key), bitmaps)


def key_sketch(keys: DataFrame, key: str, bitmaps: int) -> DataFrame:
    """bitmap, bits: the bitmaps of a column of keys, dealt to so many; nulls are left out.

    Keys are shuffled to the task that makes their bitmap, so that the shuffle grows as the keys
    do: were bits set before, tasks would hand over nearly a bitmap of 4 KB for every key. A key
    should be there once, or a few times.
    """
    dealt = (
        keys.filter(F.col(key).isNotNull())
        .select(_bitmap(F.col(key), F.lit(bitmaps).cast("long")).alias("bitmap"), F.col(key).alias("key"))
        .repartition("bitmap")
    )
    given = dealt.select("bitmap", F.explode(_places(F.col("key"))).alias("place"))
    return given.groupBy("bitmap").agg(F.bitmap_construct_agg("place").alias("bits"))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    return (F.floor(byte.cast("int") / F.pow(F.lit(2), place % 8)) % 2) == 1


def parts_that_may_hold(
    keys: DataFrame, key: str, sketches: DataFrame, parts: Sequence[Sketched]
) -> list[str]:
    """The parts whose sketch has all bits of at least one of the keys.

    `sketches` has part, bitmap and bits. A key meets one bitmap of each part. Only names of
    parts come to the driver, of which there must be few.
    """
    if not parts:
        return []
    given = F.array(*[F.struct(F.lit(p.part).alias("part"), F.lit(p.bitmaps).cast("long").alias("n")) for p in parts])
    probes = (
        keys.filter(F.col(key).isNotNull())
        .select(F.col(key).alias("key"))
        .distinct()
        .select("key", F.explode(given).alias("of"))
        .select(
            F.col("of.part").alias("part"),
            _bitmap(F.col("key"), F.col("of.n")).alias("bitmap"),
            _places(F.col("key")).alias("places"),
        )
    )
    near = sketches.filter(F.col("part").isin([p.part for p in parts]))
    met = near.join(probes, ["part", "bitmap"])
    hit = met.filter(F.forall("places", lambda place: _is_set(F.col("bits"), place)))
    return sorted(row["part"] for row in hit.select("part").distinct().collect())
