"""Written tables, groups in batches, and the most frequent rows."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from tillmart.llm import common


@pytest.mark.parametrize("seed", range(5))
def test_whole_groups(seed):
    draw = random.Random(seed)
    keys = sorted(draw.choices(range(12), k=60))
    rows = list(zip(keys, range(60)))
    cuts = sorted({0, 60, *draw.choices(range(60), k=9)})
    batches = [
        pa.RecordBatch.from_pydict({"tile": [k for k, _ in rows[a:b]], "row": [r for _, r in rows[a:b]]})
        for a, b in zip(cuts, cuts[1:])
    ]
    batches.insert(1, batches[0].slice(0, 0))
    seen, found = set(), []
    for table in common.whole_groups(batches, "tile"):
        here = set(table["tile"].to_pylist())
        assert here and not here & seen
        seen |= here
        found += table["row"].to_pylist()
    assert found == list(range(60))


def test_whole_groups_of_nothing():
    assert list(common.whole_groups([], "tile")) == []


@pytest.mark.parametrize("limit, lowest", [(0, None), (3, 400), (100, 1), (7, 20)])
def test_most_frequent(spark, limit, lowest):
    rows = [(1000, "a"), (400, "b"), (400, "c"), (20, "d"), (20, "e"), (1, "f"), (1, "g"), (1, "h")]
    found = common.most_frequent(spark.createDataFrame(rows, "n long, word string"), "n", limit)
    wanted = {word for n, word in rows if lowest is not None and n >= lowest}
    assert {r.word for r in found.collect()} == wanted and found.count() <= max(limit, 0)


def test_written_tables_lie_in_the_shared_folder(spark):
    table = common.written(spark.range(5), "numbers")
    assert sorted(r.id for r in table.collect()) == list(range(5))
    shared = spark.conf.get("spark.checkpoint.dir")
    assert all(shared in name for name in table.inputFiles())
    with common.passing_tables(spark):
        passing = common.written(table, "numbers")
        kept = common.written(passing.filter("id > 2"), "numbers", keep=True)
    assert sorted(r.id for r in kept.collect()) == [3, 4] and table.count() == 5
    with pytest.raises(Exception):
        passing.count()
    empty = common.written(spark.range(5).filter("id > 9"), "numbers")
    assert empty.count() == 0 and empty.columns == ["id"]
