"""Positions, ordered exports, top k, marts of one scan, current rows, content reconciliation."""

from __future__ import annotations

import glob
from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples import line, rows, sale, tables

from tillmart.operators.positions import with_positions
from tillmart.operators.reconcile import differences, differing_buckets
from tillmart.operators.versions import current_rows
from tillmart.plans import export, marts
from tillmart.plans.ingest import TableConfig, reconcile_rows, run_ingest
from tillmart.sources.stores import FolderStore


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- positions ----------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [None, 7])
def test_positions(spark, partitions):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n"), F.lit("x").alias("_range"))
    placed = with_positions(df, [F.desc("n")], partitions=partitions)
    assert placed.columns == ["n", "_range", "position"] or placed.columns[-1] == "position"
    assert sorted((r.position, r.n) for r in placed.collect()) == [(5000 - n, n) for n in range(4999, -1, -1)]


def test_positions_of_ties_nulls_and_nothing(spark):
    given = [(None, "a"), (1, "b"), (1, "c"), (1, "c"), (None, "a"), (0, None)]
    placed = with_positions(spark.createDataFrame(given, "n int, t string"), [F.desc_nulls_first("n")], "at")
    found = sorted((r["at"], r.n, r.t) for r in placed.collect())
    assert [at for at, _, _ in found] == [1, 2, 3, 4, 5, 6]
    assert [n for _, n, _ in found] == [None, None, 1, 1, 1, 0]
    assert Counter((n, t) for _, n, t in found) == Counter(given)
    assert with_positions(spark.range(0), [F.asc("id")]).collect() == []
    with pytest.raises(ValueError, match="have such a column"):
        with_positions(spark.range(1), [F.asc("id")], "id")


def test_a_value_of_many_rows_is_spread_over_ranges(spark):
    df = spark.range(8000).select(F.lit(1).alias("same"), "id")
    placed = with_positions(df, [F.asc("same")], partitions=8)
    assert [r.position for r in placed.orderBy("position").collect()] == list(range(1, 8001))
    shares = df.repartitionByRange(8, F.asc("same"), F.xxhash64("same", "id")).groupBy(F.spark_partition_id())
    assert shares.count().count() == 8


# --- ordered exports ------------------------------------------------------------------------


def test_part_files_follow_the_order(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("n"), F.lit('q"').alias("t"))
    export.write_csv(df, str(tmp_path / "x"), order=[F.desc("n")], files=5)
    read = []
    for name in sorted(glob.glob(str(tmp_path / "x" / "part-*"))):
        read += [int(text.split(",")[0]) for text in open(name).read().splitlines()[1:]]
    assert read == list(range(999, -1, -1))
    lines = export.ordered_lines(spark, str(tmp_path / "x")).orderBy("position").collect()
    assert [(r.position, r.line) for r in lines[:2]] == [(1, '999,"q\\""'), (2, '998,"q\\""')]
    assert len(lines) == 1000


def test_exports_of_built_in_marts_are_ordered(spark, store, tmp_path):
    sales, items = tables(spark, [sale("1")], [line(f"i{n}", "1", f"p{n % 50:02d}", quantity=n) for n in range(200)])
    store.write(sales, "sales_transactions.sales", "overwrite")
    store.write(items, "sales_transactions.sales_items", "overwrite")
    marts.run_datamarts(spark, store, store, [marts.TOP_SELLING_PRODUCTS])
    audit = export.run_export(spark, store, ["dm_sales.top_selling_products"], str(tmp_path / "out")).first()
    lines = export.ordered_lines(spark, audit.message).orderBy("position").collect()
    assert [r.line.split(",")[0] for r in lines] == [f"p{n:02d}" for n in range(49, -1, -1)]
    other = export.run_export(
        spark, store, ["dm_sales.top_selling_products"], str(tmp_path / "other"),
        orders={"dm_sales.top_selling_products": lambda: [F.asc("product_name")]},
    ).first()
    lines = export.ordered_lines(spark, other.message).orderBy("position").collect()
    assert [r.line.split(",")[0] for r in lines] == [f"p{n:02d}" for n in range(50)]


# --- top k ------------------------------------------------------------------------------------


def test_top_products(spark):
    sales, items = tables(
        spark, [sale("1", "A"), sale("2", "B"), sale("2", "B")],
        [line("a", "1", "x", quantity=2), line("b", "1", "y", quantity=2), line("c", "2", "z", quantity=1),
         line("d", "2", "x", quantity=1), line("e", "9", "w", quantity=99), line("f", "1", None, quantity=1)],
    )
    top = marts.top_products(sales, items, 2)
    assert [(r.product_name, r.total_sold) for r in top.collect()] == [("x", 4), ("y", 2)]
    assert "TakeOrderedAndProject(limit=2" in plan(top)
    by_source = marts.top_products_by_source(sales, items, 2)
    assert rows(by_source) == [("A", "x", 2, 1), ("A", "y", 2, 2), ("B", "x", 2, 1), ("B", "z", 2, 2)]
    text = plan(by_source)
    assert "WindowGroupLimit" in text and "Partial" in text.split("WindowGroupLimit", 1)[1]


# --- marts of one scan ------------------------------------------------------------------------


def header_sales(spark):
    return tables(
        spark,
        [sale("1", "A", age=29), sale("2", "A", age=None, gender=None), sale("3", None, age=21, total=None),
         sale("4", "B", name=None, age=-5), sale("4", "B", name=None, age=-5), sale(None, "B")],
        [line("a", "1")],
    )


def test_header_marts_from_one_scan(spark, store):
    sales, items = header_sales(spark)
    groups = marts.header_groups(sales)
    for table, found in marts.header_marts(groups).items():
        built = {m.target_table: m.build for m in marts.MARTS}[table](sales, items)
        assert found.schema.simpleString() == built.schema.simpleString()
        assert rows(found) == rows(built)
    store.write(sales, "s.sales", "overwrite")
    text = plan(marts.header_groups(store.read("s.sales")))
    assert text.count("FileScan parquet") == 1 and "Expand" in text


def test_run_with_one_header_scan(spark, store, tmp_path):
    sales, items = header_sales(spark)
    store.write(sales, "sales_transactions.sales", "overwrite")
    store.write(items, "sales_transactions.sales_items", "overwrite")
    apart, together = FolderStore(spark, str(tmp_path / "a")), FolderStore(spark, str(tmp_path / "b"))
    audits = [
        marts.run_datamarts(spark, store, target, one_header_scan=scan).collect()
        for target, scan in ((apart, False), (together, True))
    ]
    assert [(r.table_name, r.status, r.rows_out) for r in audits[0]] == [
        (r.table_name, r.status, r.rows_out) for r in audits[1]
    ]
    for mart in marts.MARTS:
        name = mart.target_table
        assert rows(apart.read(name).drop(marts.STAMP_COLUMN)) == rows(together.read(name).drop(marts.STAMP_COLUMN))
    one = marts.with_one_header_scan([marts.SALES_TREND, marts.SALES_FULL], store, "sales_transactions.sales")
    assert one == [marts.SALES_TREND, marts.SALES_FULL]


def test_two_marts_of_one_target_are_refused(spark, store):
    twice = [marts.Mart("dm.x", sql="SELECT 1 AS a"), marts.Mart("dm.y", sql="SELECT 1 AS a"),
             marts.Mart("dm.x", sql="SELECT 2 AS a")]
    with pytest.raises(ValueError, match="dm.x"):
        marts.run_datamarts(spark, store, store, twice)
    assert store.find("dm.y") is None


def test_names_of_a_run_do_not_outlive_it(spark, store, tmp_path):
    other = FolderStore(spark, str(tmp_path / "other"))
    store.write(spark.range(3), "stage_names.t", "overwrite")
    other.write(spark.range(5), "stage_names.t", "overwrite")
    with store.registered("stage_names.t"):
        assert store.query("SELECT * FROM stage_names.t").count() == 3
        with pytest.raises(Exception, match="(?i)already exists"):
            with other.registered("stage_names.t"):
                pass
        with other.registered("stage_names.t", schema="run_two"):
            assert other.query("SELECT * FROM run_two.t").count() == 5
        assert store.query("SELECT * FROM stage_names.t").count() == 3
    assert not spark.catalog.databaseExists("stage_names") and not spark.catalog.databaseExists("run_two")


# --- current rows ------------------------------------------------------------------------------

VERSIONS = [("a", 1, "old", 1), ("a", 3, "new", 1), ("a", 2, "mid", 2), ("b", None, "none", 9), ("b", 0, "some", 1),
            (None, 1, "x", 1), (None, 2, "y", 1), ("c", 5, "left", 1), ("c", 5, "right", 1), ("d", None, None, None)]


def test_current_rows(spark):
    schema = "k string, modified int, text string, stamp int"
    df = spark.createDataFrame(VERSIONS, schema)
    found = {r.k: tuple(r) for r in current_rows(df, ["k"], ["modified", "stamp"]).collect()}
    picked = found.pop("c")
    assert picked in VERSIONS
    assert found == {"a": VERSIONS[1], "b": VERSIONS[4], None: VERSIONS[6], "d": VERSIONS[9]}
    again = spark.createDataFrame(VERSIONS[::-1], schema).repartition(5)
    assert {r.k: tuple(r) for r in current_rows(again, ["k"], ["modified", "stamp"]).collect()}["c"] == picked
    assert current_rows(df, ["k"], ["modified"]).columns == df.columns
    assert "partial_max_by" in plan(current_rows(df, ["k"], ["modified"]))
    with pytest.raises(ValueError, match="no such columns: z"):
        current_rows(df, ["k"], ["z"])


# --- content -----------------------------------------------------------------------------------


def test_one_changed_one_lost_one_doubled_row_are_named(spark):
    source = spark.range(1000).select("id", F.concat(F.lit("t"), "id").alias("text"), F.lit(None).cast("int").alias("n"))
    target = (
        source.filter("id <> 10").union(source.filter("id = 20"))
        .withColumn("n", F.when(F.col("id") == 30, 1))
        .union(spark.createDataFrame([(None, "t", None)], "id long, text string, n int"))
    )
    found = rows(differences(source, target.repartition(7), ["id"]))
    assert found == sorted(
        [(10, "lost", 1, 0), (20, "repeated", 1, 2), (30, "changed", 1, 1), (None, "foreign", 0, 1)], key=str
    )
    assert differences(source, target, ["id"], ["text"]).filter("difference = 'changed'").count() == 0


def test_equal_tables_are_read_once(spark, store):
    source = spark.range(500).select("id", (F.col("id") % 7).alias("n"))
    store.write(source, "a", "overwrite")
    store.write(source.orderBy(F.desc("id")), "b", "overwrite")
    a, b = store.read("a"), store.read("b")
    assert differing_buckets(a, b, ["id"], ["id", "n"]) == []
    told = differences(a, b, ["id"])
    assert told.collect() == [] and "FileScan" not in plan(told)


def test_only_differing_buckets_are_compared(spark):
    source = spark.range(5000).select("id", F.lit("x").alias("t"))
    target = source.withColumn("t", F.when(F.col("id") == 7, "y").otherwise(F.col("t")))
    odd = differing_buckets(source, target, ["id"], ["id", "t"])
    assert len(odd) == 1
    assert rows(differences(source, target, ["id"])) == [(7, "changed", 1, 1)]


def test_nulls_have_places(spark):
    schema = "k int, a string, b string"
    one, two = spark.createDataFrame([(1, "x", None)], schema), spark.createDataFrame([(1, None, "x")], schema)
    assert rows(differences(one, two, ["k"])) == [(1, "changed", 1, 1)]
    with pytest.raises(ValueError, match="another type"):
        differences(one, two.withColumn("b", F.lit(1)), ["k"])
    swapped = spark.createDataFrame([(1, "x", "1"), (1, "y", "2")], schema)
    mixed = spark.createDataFrame([(1, "x", "2"), (1, "y", "1")], schema)
    assert rows(differences(swapped, mixed, ["k"])) == [(1, "changed", 2, 2)]


def test_appended_target_is_compared_by_its_current_rows(spark, store, tmp_path):
    target = FolderStore(spark, str(tmp_path / "target"))
    entry = {"source_table": "t", "target_table": "t", "fields": "k, v, at", "load_type": "delta", "delta_column": "at"}
    config = TableConfig.from_dict(entry)
    for state in ([(1, "a", 1), (2, "b", 1)], [(1, "c", 2), (2, "b", 1)]):
        store.write(spark.createDataFrame(state, "k int, v string, at int"), "t", "overwrite")
        run_ingest(spark, store, target, [config], ["t"])
    assert target.read("t").count() == 3
    assert reconcile_rows(store, target, config, ["k"]).collect() == []
    store.write(spark.createDataFrame([(1, "c", 2), (2, "z", 1)], "k int, v string, at int"), "t", "overwrite")
    assert rows(reconcile_rows(store, target, config, ["k"])) == [(2, "changed", 1, 1)]
