from __future__ import annotations

import glob
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tillmart.operators.days import on_days
from tillmart.operators.lines import sale_lines, sold_by_product
from tillmart.plans import config as job_config
from tillmart.plans.export import folder_name, read_csv, write_csv
from tillmart.sources.scratch import require_shared, scratch_dir
from tillmart.sources.stores import (
    CatalogStore,
    FolderStore,
    JdbcStore,
    MissingTable,
    ReadSplit,
    _sql_state,
    zone_timestamps,
)
from tillmart.plans.ingest import TableConfig, run_ingest
from samples import line, rows, sale, tables


def test_missing_and_empty_folders(spark, store, tmp_path):
    assert store.find("no.such") is None
    with pytest.raises(MissingTable):
        store.read("no.such")
    (tmp_path / "void").mkdir()
    assert store.find("void") is None


def test_a_broken_table_is_not_a_missing_one(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part.parquet").write_text("no parquet at all")
    with pytest.raises(Exception) as caught:
        FolderStore(spark, str(tmp_path)).find("t").count()
    assert not isinstance(caught.value, MissingTable)


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_folder_formats(spark, tmp_path, format):
    schema = (
        "k string, n int, price decimal(10,2), at timestamp_ntz, day date, big bigint, none string, "
        "stamp timestamp"
    )
    day = date(2025, 1, 2)
    stamp = datetime(2025, 1, 2, 3, 4, 5, 678000)
    given = [
        ("1", 1, Decimal("1.50"), datetime(2025, 1, 2, 3, 4, 5, 600000), day, 1 << 60, None, stamp),
        ('a "b", c', None, None, None, None, None, None, None),
        (" lead\\", 0, Decimal("-0.01"), datetime(1999, 12, 31), day, -1, None, stamp),
        ("", 7, Decimal("0.00"), datetime(2000, 2, 29), day, 0, None, stamp),
    ]
    df = spark.createDataFrame(given, schema)
    schemas = {"a.b": df.schema} if format in ("json", "csv") else {}
    store = FolderStore(spark, str(tmp_path), format, schemas=schemas)
    assert store.find("a.b") is None
    store.write(df, "a.b", "overwrite")
    assert rows(store.read("a.b")) == rows(df)
    assert [f.dataType for f in store.read("a.b").schema] == [f.dataType for f in df.schema]
    store.write(df, "a.b", "append")
    assert store.read("a.b").count() == store.count("a.b") == 8


@pytest.mark.parametrize("format", ["json", "csv"])
def test_text_tables_need_their_schema(spark, tmp_path, format):
    df = spark.range(3)
    bare = FolderStore(spark, str(tmp_path), format)
    for call in (lambda: bare.write(df, "t", "append"), lambda: bare.read("t")):
        with pytest.raises(ValueError, match="needs a schema"):
            call()
    typed = FolderStore(spark, str(tmp_path), format, schemas={"s.t": df.schema})
    with pytest.raises(ValueError, match="do not have the schema"):
        typed.write(df.withColumn("more", F.lit(1)), "s.t", "append")
    with pytest.raises(ValueError, match="would not know its types"):
        typed.register("s.t")


def test_a_delta_load_into_a_text_table(spark, tmp_path, store):
    source_rows = spark.createDataFrame([(n, datetime(2025, 1, n)) for n in range(1, 6)], "n int, at timestamp_ntz")
    stamped = source_rows.withColumn("ingest_timestamp", F.current_timestamp()).schema
    target = FolderStore(spark, str(tmp_path / "csv"), "csv", schemas={"t": stamped})
    entry = {"source_table": "t", "target_table": "t", "fields": "*", "load_type": "delta", "delta_column": "at"}
    for upto in (3, 5, 5):
        store.write(source_rows.filter(F.col("n") <= upto), "t", "overwrite")
        run_ingest(spark, store, target, [TableConfig.from_dict(entry)], ["t"])
    assert sorted(r.n for r in target.read("t").collect()) == [1, 2, 3, 4, 5]


def test_rows_are_counted_once_they_are_gathered(spark, store):
    seen = Observation()
    df = spark.range(100).withColumn("p", F.col("id") % 3)
    store.write(df, "t", "overwrite", ["p"], seen)
    assert seen.get == {"rows": 100}


def test_partitioned_write_keeps_a_hot_value_whole(spark, store):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("p"))
    store.write(df, "t", "overwrite", ["p"])
    assert store.read("t").count() == 1000
    assert len(glob.glob(store.path("t") + "/p=0/*.parquet")) <= 4


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    store = CatalogStore(
        spark,
        str(tmp_path),
        {"bucketed.sales": ("transaction_id", 4), "bucketed.items": ("transaction_id", 4)},
    )
    sales, items = tables(spark, [sale("1"), sale("2")], [line("a", "1"), line("b", "9")])
    assert store.find("bucketed.sales") is None
    store.write(sales, "bucketed.sales", "overwrite")
    store.write(items, "bucketed.items", "overwrite")
    joined = sale_lines(store.read("bucketed.sales"), store.read("bucketed.items"))
    assert joined.count() == 1
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert store.query("SELECT count(*) FROM bucketed.sales").first()[0] == 2
    sold = sold_by_product(store.read("bucketed.sales"), store.read("bucketed.items"))
    assert sold.count() == 1
    plan = sold._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert re.findall(r"Exchange (\w+)\((\w+)", plan) == [("hashpartitioning", "product_name")]


def jdbc(spark):
    return JdbcStore(spark, "jdbc:some:db", "me", "secret", "some.Driver")


def test_jdbc_options(spark):
    store = jdbc(spark)
    assert store.read_options("s.t", 500, None) == {
        "url": "jdbc:some:db", "user": "me", "password": "secret", "driver": "some.Driver",
        "dbtable": "s.t", "fetchsize": "500",
    }
    split = store.read_options("s.t", 500, ReadSplit("id", "0", "900", 9))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "0", "900", "9",
    )
    assert store.write_options("s.t")["batchsize"] == "10000"
    assert store.write_options("s.t")["numPartitions"] == "16"
    store.count = lambda table: 1_000_001
    with pytest.raises(ValueError, match="needs a split"):
        store.read("s.t")
    with pytest.raises(ValueError, match="not stored by"):
        store.write(spark.range(1), "s.t", "append", ["id"])
    assert "secret" not in repr(store)


def test_jdbc_missing_table_is_told_by_sql_state(spark):
    jvm = spark.sparkContext._jvm

    def raised(cause):
        return Py4JJavaError("x", jvm.java.lang.RuntimeException("outer", cause))

    assert _sql_state(spark, raised(jvm.java.sql.SQLException("no such table", "42P01"))) == "42P01"
    assert _sql_state(spark, raised(jvm.java.lang.RuntimeException("other"))) is None
    assert _sql_state(spark, AnalysisException("x")) is None


def test_zoned_timestamps(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2025-01-01 10:00:00' AS t, 1 AS n")
    assert [f.dataType.simpleString() for f in zone_timestamps(df).schema] == ["timestamp", "int"]


def test_connections_take_secrets_from_the_environment(spark):
    text = '{"source": {"host": "jdbc:x", "user": "$DB_USER", "password": "$DB_PASSWORD", "driver": "d"}}'
    found = job_config.connections(spark, text, {"DB_USER": "u", "DB_PASSWORD": "p"})["source"]
    assert (found.url, found.user, found.password, found.driver) == ("jdbc:x", "u", "p", "d")


def test_json_configs():
    tables_text = (
        '[{"source_table": "t", "fields": "a, b", "load_type": "DELTA", "delta_column": "c",'
        ' "target_table": "u", "partition_column": "id", "lower_bound": 0, "upper_bound": 9,'
        ' "num_partitions": 3}]'
    )
    (entry,) = job_config.table_configs(tables_text)
    assert entry.fields == ("a", "b") and entry.is_delta and entry.split == ReadSplit("id", "0", "9", 3)
    (mart,) = job_config.mart_configs('[{"target_table": "m", "sql": "SELECT 1"}]')
    assert (mart.sql, dict(mart.mask_columns)) == ("SELECT 1", {})
    assert job_config.table_list('["a", "b"]') == ["a", "b"]


def test_scratch_lies_in_the_shared_folder(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")


def test_scratch_without_a_shared_folder_lies_beside_the_warehouse(spark, monkeypatch):
    monkeypatch.setattr("tillmart.sources.scratch.SHARED_DIR_SETTING", "spark.not.set")
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch/x-")


def test_a_cluster_gets_no_scratch_on_the_drivers_disk():
    require_shared("local[4]", "file")
    require_shared("spark://host:7077", "hdfs")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        require_shared("yarn", "file")


def test_scratch_lies_where_the_caller_says(spark, tmp_path):
    assert scratch_dir(spark, "x", str(tmp_path)).startswith(f"{tmp_path}/x-")


def test_export_names():
    assert folder_name("a.b_c", datetime(2025, 1, 2, 3, 4, 5)) == "a_b_c_20250102_030405"


def test_csv_dialect(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, " lead", "", None), (2, 'a "b"', "x,y", "z ")], "n int, a string, b string, c string"
    ).coalesce(1)
    assert write_csv(df, str(tmp_path / "plain")) == 2
    (part,) = glob.glob(str(tmp_path / "plain" / "part-*.csv"))
    assert open(part).read().splitlines() == ["n,a,b,c", '1,lead,"",', '2,"a \\"b\\"","x,y",z']
    write_csv(df, str(tmp_path / "exact"), lossless=True)
    assert rows(read_csv(spark, str(tmp_path / "exact"), df.schema)) == rows(df)


def test_csv_with_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "two\nlines"), (2, 'q"\n,')], "n int, a string")
    write_csv(df, str(tmp_path / "exact"), lossless=True)
    assert rows(read_csv(spark, str(tmp_path / "exact"), df.schema, line_breaks=True)) == rows(df)


def test_stored_tables_are_compressed_well(spark, store, tmp_path):
    store.write(spark.range(1), "t", "overwrite")
    assert glob.glob(f"{tmp_path}/t/*.zstd.parquet")


def test_few_days_of_a_large_table_are_joined_without_a_shuffle(spark):
    many = spark.range(3_000_000).select(F.make_date(F.lit(2025), F.lit(9), F.col("id") % 28 + 1).alias("day"))
    rows = spark.range(3_000_000).select(
        (F.lit(datetime(2025, 9, 20)).cast("timestamp_ntz") + F.make_dt_interval(F.col("id") % 20)).alias("transaction_date")
    )
    chosen = on_days(rows, many)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert chosen.count() == 3_000_000 * 9 // 20
