from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillmart.operators.sketches import Sketched, bitmaps_for, key_sketch, parts_that_may_hold


def keys(spark, start, stop):
    return spark.range(start, stop).select(F.concat(F.lit("k"), "id").alias("key"))


@pytest.fixture(scope="module")
def sketches(spark):
    found = None
    for part, (start, stop) in {"a": (0, 2000), "b": (2000, 2300), "c": (2300, 2301)}.items():
        made = key_sketch(keys(spark, start, stop), "key", bitmaps_for(stop - start))
        made = made.withColumn("part", F.lit(part))
        found = made if found is None else found.unionByName(made)
    return found.cache()


PARTS = [Sketched("a", 4), Sketched("b", 1), Sketched("c", 1)]


def test_no_key_is_missed(spark, sketches):
    assert parts_that_may_hold(keys(spark, 1999, 2001), "key", sketches, PARTS) == ["a", "b"]
    assert parts_that_may_hold(keys(spark, 0, 2301), "key", sketches, PARTS) == ["a", "b", "c"]
    for n in (0, 777, 1500, 1999):
        assert parts_that_may_hold(keys(spark, n, n + 1), "key", sketches, PARTS) == ["a"]


def test_other_keys_are_told_apart(spark, sketches):
    assert parts_that_may_hold(keys(spark, 10_000, 30_000), "key", sketches, PARTS) == []
    assert parts_that_may_hold(keys(spark, 0, 2301), "key", sketches, PARTS[1:]) == ["b", "c"]


def test_nulls_and_nothing(spark, sketches):
    nulls = spark.createDataFrame([(None,)], "key string")
    assert key_sketch(nulls, "key", 1).count() == 0
    assert parts_that_may_hold(nulls, "key", sketches, PARTS) == []
    assert parts_that_may_hold(keys(spark, 0, 10), "key", sketches, []) == []


def test_size_of_sketches(spark, sketches):
    assert bitmaps_for(0) == bitmaps_for(500) == 1 and bitmaps_for(501) == 2
    assert {len(r.bits) for r in sketches.collect()} == {4096}
    assert sketches.count() == 6


def test_keys_are_shuffled_and_no_bits(spark):
    plan = key_sketch(keys(spark, 0, 9), "key", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "bitmap_construct_agg" not in plan.split("Exchange", 1)[1]
