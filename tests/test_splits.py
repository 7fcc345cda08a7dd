from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from tillmart.plans import config as job_config
from tillmart.plans import export
from tillmart.sources import stores
from tillmart.sources.splits import (
    EquiDepth,
    KeyRange,
    bounds_sql,
    equi_depth,
    literal,
    part_sizes,
    ranges_of,
)
from tillmart.sources.stores import JdbcStore, ReadSplit


def sizes(df, ranges):
    return {r.part: r.rows for r in part_sizes(df, ranges).collect()}


def skewed(spark, value):
    """A third of the rows share one key, some have none, the others thin out."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 500).when(n % 50 == 1, None).otherwise(F.floor(F.pow(n, 1.5) / 40))
    return spark.range(6000).select(value(key).alias("k"), n.alias("tie"))


KINDS = {
    "long": lambda k: k.cast("long"),
    "decimal": lambda k: k.cast("decimal(12,2)"),
    "date": lambda k: F.date_add(F.lit("2000-01-01"), k.cast("int")),
    "timestamp": lambda k: F.timestamp_seconds(k),
    "ntz": lambda k: F.timestamp_seconds(k).cast("timestamp_ntz"),
    "string": lambda k: F.concat(F.lit("it's "), F.lpad(k.cast("string"), 6, "0")),
}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_parts_are_disjoint_complete_and_even(spark, kind):
    df = skewed(spark, KINDS[kind]).cache()
    plain = sizes(df, equi_depth(df, EquiDepth("k", 10)))
    assert sum(plain.values()) == 6000 and min(plain) == 0
    assert max(plain.values()) >= 2000  # one value cannot be cut along its own column
    cut = sizes(df, equi_depth(df, EquiDepth("k", 10, within="tie")))
    assert sum(cut.values()) == 6000 and min(cut) == 0 and len(cut) >= 9
    assert max(cut.values()) <= 1.5 * 600


def test_nothing_and_one_value(spark):
    empty = spark.createDataFrame([], "k long, tie long")
    assert equi_depth(empty, EquiDepth("k", 4, "tie")) == [KeyRange("k", nulls=True)]
    nulls = spark.createDataFrame([(None, 1)] * 5, "k long, tie long")
    assert sum(sizes(nulls, equi_depth(nulls, EquiDepth("k", 4))).values()) == 5
    same = spark.range(100).select(F.lit(7).alias("k"), F.col("id").alias("tie"))
    assert sizes(same, equi_depth(same, EquiDepth("k", 4))) == {0: 100}
    cut = sizes(same, equi_depth(same, EquiDepth("k", 4, "tie")))
    assert sorted(cut) == [0, 1, 2, 3] and sum(cut.values()) == 100 and max(cut.values()) <= 27


def test_conditions_as_sql_mean_the_same(spark):
    df = skewed(spark, KINDS["string"]).cache()
    ranges = equi_depth(df, EquiDepth("k", 6, within="tie"))
    df.createOrReplaceTempView("split_rows")
    held = duckdb.connect()
    held.register("split_rows", df.toPandas())
    for part, count in sizes(df, ranges).items():
        condition = ranges[part].sql()
        assert spark.sql(f"SELECT 1 FROM split_rows WHERE {condition.replace(chr(39) * 2, chr(92) + chr(39))}").count() == count
        assert held.execute(f"SELECT count(*) FROM split_rows WHERE {condition}").fetchone()[0] == count


def test_bounds_found_by_a_database(spark):
    held = duckdb.connect()
    rows = skewed(spark, KINDS["long"]).toPandas()
    held.register("t", rows)
    bounds = [row[0] for row in held.execute(bounds_sql("t", "k", 8)).fetchall()]
    ranges = ranges_of("k", bounds)
    counts = [held.execute(f"SELECT count(*) FROM t WHERE {r.sql()}").fetchone()[0] for r in ranges]
    assert sum(counts) == 6000 and len(counts) >= 5
    assert sorted(counts)[-2] <= 1.5 * 750


def test_literals():
    assert [literal(v) for v in (5, Decimal("1.50"), "o'k", date(2025, 1, 2), datetime(2025, 1, 2, 3, 4, 5, 6))] == [
        "5", "1.50", "'o''k'", "DATE '2025-01-02'", "TIMESTAMP '2025-01-02 03:04:05.000006'",
    ]
    with pytest.raises(ValueError):
        literal(None)
    assert KeyRange("k").sql() == "k IS NOT NULL" and KeyRange("k", nulls=True).sql() == "1 = 1"
    assert KeyRange("k", None, 3, True).sql() == "(k IS NULL OR k < 3)"


# --- connections of a configuration; no database runs here -----------------------------

CONNECTIONS = json.dumps({"datamart": {
    "host": "jdbc:x", "user": "u", "password": "p", "driver": "d",
    "splits": {
        "dm.wide": {"partition_column": "id", "lower_bound": 0, "upper_bound": 9, "num_partitions": 3},
        "dm.even": {"partition_column": "k", "num_partitions": 4, "within": "tie"},
    },
}})


class Recorded(JdbcStore):
    """Answers statements from DuckDB, and scans from their conditions there."""

    def query(self, sql, split=None):
        if split is not None:
            return super().query(sql, split)
        names = [c[0] for c in self.held.execute(sql).description]
        rows = self.held.execute(sql).fetchall()
        return self.spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{n} long" for n in names))

    def _load(self, table, options):
        self.scans = [options]
        return self.query(f"SELECT * FROM {table}")

    def _load_parts(self, table, fetch_size, ranges):
        self.scans = [self.query(f"SELECT * FROM {table} WHERE {r.sql()}") for r in ranges]
        whole = self.scans[0]
        for part in self.scans[1:]:
            whole = whole.union(part)
        return whole


@pytest.fixture
def database(spark):
    store = job_config.connections(spark, CONNECTIONS)["datamart"]
    store.__class__ = Recorded
    store.held = duckdb.connect()
    store.held.register("rows", skewed(spark, KINDS["long"]).toPandas())
    store.held.execute("CREATE SCHEMA dm")
    for name in ("even", "wide", "small"):
        store.held.execute(f"CREATE TABLE dm.{name} AS SELECT CAST(k AS BIGINT) AS k, tie, tie AS id FROM rows")
    return store


def test_splits_of_a_connection(database):
    assert database.splits == {
        "dm.wide": ReadSplit("id", "0", "9", 3), "dm.even": EquiDepth("k", 4, "tie"),
    }
    assert database.read("dm.wide").count() == 6000
    assert database.scans[0]["partitionColumn"] == "id" and database.scans[0]["numPartitions"] == "3"
    assert database.read("dm.even").count() == 6000
    counts = [part.count() for part in database.scans]
    assert sum(counts) == 6000 and len(counts) >= 4 and max(counts) <= 1.5 * 1500
    assert database.query("SELECT * FROM dm.even", EquiDepth("tie", 3)).count() == 6000


def test_export_over_a_configured_connection(spark, database, tmp_path, monkeypatch):
    audit = export.run_export(spark, database, ["dm.wide", "dm.even", "dm.small"], str(tmp_path), at_once=1)
    assert [(r.status, r.rows_out) for r in audit.collect()] == [("DONE", 6000)] * 3
    monkeypatch.setattr(stores, "SINGLE_CONNECTION_ROWS", 5999)
    audit = export.run_export(spark, database, ["dm.small"], str(tmp_path)).first()
    assert audit.status == "FAILED" and "needs a split" in audit.message


def test_splits_of_a_table_configuration():
    (entry,) = job_config.table_configs(
        '[{"source_table": "t", "fields": "*", "load_type": "delta", "target_table": "u",'
        ' "partition_column": "id", "num_partitions": 5,'
        ' "target_split": {"partition_column": "id", "lower_bound": 1, "upper_bound": 2, "num_partitions": 2}}]'
    )
    assert entry.split == EquiDepth("id", 5) and entry.target_split == ReadSplit("id", "1", "2", 2)
