from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from samples import rows

from tillmart.plans.ingest import TableConfig, pick_configs, run_ingest
from tillmart.sources.stores import FolderStore

T0 = datetime(2025, 1, 1)
T1 = datetime(2025, 1, 2)
T2 = datetime(2025, 1, 3)


@pytest.fixture
def stores(spark, tmp_path):
    return FolderStore(spark, str(tmp_path / "from")), FolderStore(spark, str(tmp_path / "to"))


def put(store, data, table="shop.t"):
    df = store.spark.createDataFrame(data, "id int, name string, changed timestamp_ntz")
    store.write(df, table, "overwrite")


def config(**changes):
    entry = {
        "source_schema": "shop",
        "source_table": "t",
        "fields": "*",
        "load_type": "full",
        "target_schema": "stage",
        "target_table": "t",
    }
    return TableConfig.from_dict(entry | changes)


def load(spark, stores, times=1, **changes):
    for _ in range(times):
        audit = run_ingest(spark, *stores, [config(**changes)], ["t"]).collect()
    return audit[0]


def ids(stores):
    return sorted(r.id for r in stores[1].read("stage.t").collect())


def test_full_load_twice_is_once(spark, stores):
    put(stores[0], [(1, "a", T0), (2, "b", T1)])
    row = load(spark, stores, times=2, load_type="FULL", delta_column="changed")
    assert ids(stores) == [1, 2]
    assert (row.status, row.rows_in, row.rows_out) == ("DONE", 2, 2)
    loaded = stores[1].read("stage.t")
    assert loaded.columns == ["id", "name", "changed", "ingest_timestamp"]
    assert loaded.select("ingest_timestamp").distinct().count() == 1


def test_other_load_types_append(spark, stores):
    put(stores[0], [(1, "a", T0)])
    load(spark, stores, times=2, load_type="history")
    assert ids(stores) == [1, 1]


def test_delta_without_column_appends_everything(spark, stores):
    put(stores[0], [(1, "a", T0)])
    load(spark, stores, times=2, load_type="delta")
    assert ids(stores) == [1, 1]


def test_fields_are_trimmed(spark, stores):
    put(stores[0], [(1, "a", T0)])
    load(spark, stores, fields=" id ,changed")
    assert stores[1].read("stage.t").columns == ["id", "changed", "ingest_timestamp"]


DELTA = {"load_type": "Delta", "delta_column": "changed"}


def test_delta_into_missing_target_loads_all(spark, stores):
    put(stores[0], [(1, "a", T0), (2, "b", None)])
    row = load(spark, stores, **DELTA)
    assert ids(stores) == [1, 2] and row.rows_out == 2


def test_delta_into_empty_target_loads_all(spark, stores):
    put(stores[0], [(1, "a", T0), (2, "b", None)])
    put(stores[1], [], "stage.t")
    load(spark, stores, **DELTA)
    assert ids(stores) == [1, 2]


def test_delta_takes_only_rows_above_the_mark(spark, stores):
    put(stores[0], [(1, "a", T0), (2, "b", T1)])
    load(spark, stores, **DELTA)
    put(stores[0], [(1, "a2", T2), (2, "b", T1), (3, "late tie", T1), (4, "old", T0), (5, "none", None)])
    row = load(spark, stores, **DELTA)
    assert ids(stores) == [1, 1, 2]
    assert row.rows_out == 1
    row = load(spark, stores, **DELTA)
    assert ids(stores) == [1, 1, 2] and row.rows_out == 0


def test_delta_with_tie_key_takes_late_ties(spark, stores):
    put(stores[0], [(1, "a", T0), (2, "b", T1)])
    load(spark, stores, **DELTA)
    put(stores[0], [(1, "a", T0), (2, "b", T1), (3, "late tie", T1), (4, "new", T2)])
    load(spark, stores, times=2, tie_key="id", **DELTA)
    assert ids(stores) == [1, 2, 3, 4]


def test_a_null_tie_key_is_loaded_once(spark, stores):
    put(stores[0], [(None, "a", T1), (2, "b", T1)])
    load(spark, stores, times=3, tie_key="id", **DELTA)
    assert stores[1].read("stage.t").count() == 2


def test_tie_key_must_be_loaded(spark, stores):
    put(stores[0], [(1, "a", T0)])
    load(spark, stores, **DELTA)
    with pytest.raises(ValueError, match="tie key"):
        load(spark, stores, fields="name,changed", tie_key="id", **DELTA)


def test_delta_column_must_be_loaded(spark, stores):
    put(stores[0], [(1, "a", T0)])
    with pytest.raises(ValueError, match="delta column"):
        load(spark, stores, fields="id,name", **DELTA)
    assert stores[1].find("stage.t") is None


def test_mark_reaches_the_scan(spark, stores):
    from tillmart.operators.delta import newer_than

    put(stores[0], [(1, "a", T0)])
    mark = F.lit("2025-01-02").cast("timestamp_ntz")
    plan = newer_than(stores[0].read("shop.t"), "changed", mark)._jdf.queryExecution().toString()
    assert "GreaterThan(changed,2025-01-02T00:00)" in plan


def test_reconcile_counts_source_and_target(spark, stores):
    put(stores[0], [(1, "a", T0), (2, "b", T1)])
    put(stores[1], [], "stage.t")
    run_ingest(spark, *stores, [config(**DELTA)], ["t"])
    put(stores[0], [(1, "a", T0), (2, "b", T1), (3, "c", T2)])
    row = run_ingest(spark, *stores, [config(**DELTA)], ["t"], reconcile=True).first()
    assert (row.rows_in, row.rows_out) == (3, 1)
    assert row.message == "delta load, append, source 3, target 3"


def test_unlisted_tables_are_skipped_and_unknown_ones_recorded(spark, stores):
    put(stores[0], [(1, "a", T0)])
    put(stores[0], [(1, "a", T0)], "shop.u")
    configs = [config(), config(source_table="u", target_table="u")]
    audit = run_ingest(spark, *stores, configs, ["nowhere", "shop.t"]).collect()
    assert [(r.table_name, r.status) for r in audit] == [("nowhere", "SKIPPED"), ("stage.t", "DONE")]
    assert stores[1].find("stage.u") is None


def test_a_failing_load_ends_the_run_and_is_recorded(spark, stores):
    put(stores[0], [(1, "a", T0)])
    configs = [config(source_table="gone", target_table="gone"), config()]
    with pytest.raises(LookupError):
        run_ingest(spark, *stores, configs, ["gone", "t"], audit=(stores[1], "audit.runs"))
    saved = stores[1].read("audit.runs").collect()
    assert [(r.table_name, r.status) for r in saved] == [("stage.gone", "FAILED")]
    assert stores[1].find("stage.t") is None


def test_bare_names_must_be_unambiguous():
    two = [config(), config(source_schema="other")]
    assert pick_configs(two, ["other.t"])[0][1].source == "other.t"
    with pytest.raises(ValueError, match="ambiguous"):
        pick_configs(two, ["t"])


def test_schemas_are_optional():
    plain = config(source_schema=None, target_schema="")
    assert (plain.source, plain.target, plain.batch_size) == ("t", "t", 10000)


def test_loaded_values_are_unchanged(spark, stores):
    put(stores[0], [(1, "a", T0), (2, None, None)])
    load(spark, stores)
    assert rows(stores[1].read("stage.t").drop("ingest_timestamp")) == rows(stores[0].read("shop.t"))
    assert stores[1].read("stage.t").filter(F.col("ingest_timestamp").isNull()).count() == 0


@pytest.mark.parametrize(
    "type_, low, high",
    [
        ("timestamp_ntz", "2018-11-03 23:59:59.999999", "2018-11-04 00:00:00"),
        ("timestamp", "2018-02-17T22:30:00.000001-03:00", "2018-02-18T00:30:00-02:00"),
        ("date", "2025-01-01", "2025-01-02"),
        ("int", "9", "10"),
        ("bigint", "9007199254740993", "9007199254740994"),
        ("double", "0.1", "0.10000000000000002"),
        ("decimal(38,18)", "0.000000000000000001", "0.000000000000000002"),
        ("string", "a'b", "b"),
    ],
)
@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Manila"])
def test_marks_of_every_type_are_exact(spark, stores, settings, type_, low, high, zone):
    """Run in a zone that is not the Python process's, around its clock changes."""
    settings(spark__sql__session__timeZone=zone)
    values = spark.createDataFrame([(1, low), (2, high)], "id int, c string").select(
        "id", F.col("c").cast(type_).alias("changed")
    )
    stores[0].write(values.filter("id = 1"), "shop.t", "overwrite")
    load(spark, stores, times=2, **DELTA)
    assert ids(stores) == [1]
    stores[0].write(values, "shop.t", "overwrite")
    load(spark, stores, times=2, **DELTA)
    assert ids(stores) == [1, 2]
