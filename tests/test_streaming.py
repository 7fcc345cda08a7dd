from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F
from samples import FLAT, NESTED, rows

from tillmart.plans.ingest import TableConfig, run_ingest
from tillmart.sources.stores import CatalogStore, FolderStore, MissingTable, _gathered
from tillmart.streaming.intake import SalesIntake, _fated


def put(spark, path, *texts):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(path)


def run(intake, spark, tmp_path, checkpoint, **options):
    intake.start(
        spark, str(tmp_path / "in"), str(tmp_path / checkpoint), **options
    ).awaitTermination()


def counts(store, intake):
    tables = (intake.sales_table, intake.items_table, intake.acks_table, intake.rejects_table)
    found = [intake.find(table) for table in tables]
    return tuple(0 if table is None else table.count() for table in found)


def payloads(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def sent(spark, start, number):
    """Payloads of so many new sales."""
    return payloads(spark, *[FLAT.replace("F-1", f"S-{n}") for n in range(start, start + number)])


def test_intake_and_replays(spark, store, tmp_path):
    intake = SalesIntake(store)
    put(spark, str(tmp_path / "in"), NESTED, FLAT, NESTED, NESTED[:-1])
    run(intake, spark, tmp_path, "first")
    assert counts(store, intake) == (2, 3, 2, 1)
    run(intake, spark, tmp_path, "first")
    assert counts(store, intake) == (2, 3, 2, 1)
    put(spark, str(tmp_path / "in"), FLAT, FLAT.replace("F-1", "F-2"))
    run(intake, spark, tmp_path, "first")
    assert counts(store, intake) == (3, 4, 3, 1)
    run(intake, spark, tmp_path, "second", files_per_batch=1)
    assert counts(store, intake) == (3, 4, 3, 1)
    assert intake.read(intake.rejects_table).first().raw == NESTED[:-1]


def broken_at(store, number):
    """Makes the store's nth write of a batch fail, and the names of the tables written."""
    real_write, written = store.write, []

    def write(df, table, mode, partition_by=(), rows=None):
        written.append(table)
        if len(written) == number:
            raise IOError("lost")
        real_write(df, table, mode, partition_by, rows)

    store.write = write
    return real_write, written


def test_a_batch_that_breaks_off_shows_in_no_table(spark, store, tmp_path):
    intake = SalesIntake(store)
    put(spark, str(tmp_path / "in"), NESTED, FLAT, NESTED[:-1])
    tables = [*intake.row_tables, intake.sketches_table, intake.commits_table]
    for number in range(1, len(tables) + 1):
        real_write, written = broken_at(store, number)
        with pytest.raises(Exception):
            run(intake, spark, tmp_path, "one")
        store.write = real_write
        assert len(written) == number
        assert counts(store, intake) == (0, 0, 0, 0) and intake.batches() == []
    run(intake, spark, tmp_path, "one")
    assert counts(store, intake) == (2, 3, 2, 1)
    assert sorted(written) == sorted(tables)
    assert store.read(intake.sales_table).count() > 2  # parts of broken batches, which no reader sees


def test_later_jobs_read_committed_rows(spark, store, tmp_path):
    intake = SalesIntake(store)
    with pytest.raises(MissingTable):
        intake.committed().read(intake.sales_table)
    real_write, _ = broken_at(store, 4)
    with pytest.raises(IOError):
        intake.take(payloads(spark, NESTED))
    store.write = real_write
    intake.take(payloads(spark, FLAT))
    target = FolderStore(spark, str(tmp_path / "staging"))
    entry = {"source_schema": "sales_transactions", "source_table": "sales", "fields": "*",
             "target_table": "sales", "load_type": "full"}
    run_ingest(spark, intake.committed(), target, [TableConfig.from_dict(entry)], ["sales"])
    assert [r.transaction_id for r in target.read("sales").collect()] == ["F-1"]
    with pytest.raises(ValueError, match="written by the intake"):
        intake.committed().write(spark.range(1), "t", "append")


BARE = '{"salesId":"F-1","products":[],"amountDue":9.00,"creationDate":"2025-01-01T00:00:00Z"}'


def rejects(store, intake):
    return sorted((r.reject_reason, r.raw) for r in intake.read(intake.rejects_table).collect())


def test_a_later_payload_of_a_known_sale_is_kept_as_superseded(spark, store, tmp_path):
    intake = SalesIntake(store)
    put(spark, str(tmp_path / "in"), BARE)
    run(intake, spark, tmp_path, "one")
    assert counts(store, intake) == (1, 0, 1, 0)
    put(spark, str(tmp_path / "in"), FLAT)
    run(intake, spark, tmp_path, "one")
    assert counts(store, intake) == (1, 0, 1, 1)
    assert rejects(store, intake) == [("superseded", FLAT)]


def test_differing_payloads_of_one_sale_are_not_mixed(spark, store, tmp_path):
    intake = SalesIntake(store)
    put(spark, str(tmp_path / "in"), FLAT, BARE, FLAT, BARE)
    run(intake, spark, tmp_path, "one")
    assert counts(store, intake) == (1, 0, 1, 1)
    assert str(intake.read(intake.sales_table).first().total_amount) == "9.00"
    assert rejects(store, intake) == [("superseded", FLAT)]


def test_a_broken_batch_that_comes_back_larger_is_decided_anew(spark, store):
    intake = SalesIntake(store)
    real_write, _ = broken_at(store, 3)
    with pytest.raises(IOError):
        intake.take(payloads(spark, FLAT))
    store.write = real_write
    intake.take(payloads(spark, FLAT, BARE))
    assert counts(store, intake) == (1, 0, 1, 1)  # the earlier payload, with no line of the other
    assert rejects(store, intake) == [("superseded", FLAT)]
    intake.take(payloads(spark, FLAT, BARE))
    assert counts(store, intake) == (1, 0, 1, 1)


def test_a_batch_of_new_sales_reads_no_stored_row(spark, store):
    intake = SalesIntake(store, merge_at=4)
    for number in range(6):
        intake.take(sent(spark, number * 400, 400))
    live = intake.batches()
    assert sorted(b.level for b in live) == [0, 0, 1] and sum(b.sale_keys for b in live) == 2400
    asked = sent(spark, 2400, 400).select(F.get_json_object("value", "$.salesId").alias("k"))
    asked = asked.withColumnRenamed("k", "transaction_id")
    assert intake._held(asked, "transaction_id", intake.choices_table, "sale", live) is None
    one = spark.createDataFrame([("S-2100",)], "transaction_id string")
    held = intake._held(one, "transaction_id", intake.choices_table, "sale", live)
    assert held.filter("transaction_id = 'S-2100'").count() == 1
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and sum(b.batch in plan for b in live) == 1


def test_batches_are_rewritten_and_replays_still_known(spark, store, tmp_path):
    intake = SalesIntake(store, merge_at=2)
    first = sent(spark, 0, 3)
    for number in range(9):
        intake.take(sent(spark, number * 3, 3))
        if number == 4:
            intake.take(payloads(spark, NESTED[:-1], BARE.replace("F-1", "S-0")))
    assert counts(store, intake) == (27, 27, 27, 2)
    live = intake.batches()
    assert len(live) <= 4 and len({b.level for b in live}) == len(live)
    files = glob.glob(f"{tmp_path}/sales_transactions/sales/**/*.parquet", recursive=True)
    assert len(files) <= 9
    assert len(glob.glob(f"{tmp_path}/sales_transactions/intake_commits/*")) <= 3
    intake.take(first)
    intake.take(payloads(spark, NESTED[:-1], BARE.replace("F-1", "S-0")))
    assert counts(store, intake) == (27, 27, 27, 2) and intake.batches() == live


def test_a_rewriting_that_breaks_off_loses_and_doubles_nothing(spark, store):
    intake = SalesIntake(store, merge_at=2)
    intake.take(sent(spark, 0, 2))
    for number in (8, 5, 6):  # in the rewriting of the rows, of the sketches, of the log
        real_write, _ = broken_at(store, number)
        with pytest.raises(IOError):
            intake.take(sent(spark, 2, 2))
        store.write = real_write
        assert counts(store, intake) == (4, 4, 4, 0)
    intake.take(sent(spark, 0, 4))
    assert counts(store, intake) == (4, 4, 4, 0) and [b.level for b in intake.batches()] == [1]


def test_readers_that_began_before_a_rewriting_can_go_on(spark, store):
    intake = SalesIntake(store, merge_at=2)
    intake.take(sent(spark, 0, 2))
    begun = intake.read(intake.sales_table)
    intake.take(sent(spark, 2, 2))
    assert begun.count() == 2 and intake.read(intake.sales_table).count() == 4


def test_tables_of_the_catalog(spark, tmp_path):
    intake = SalesIntake(CatalogStore(spark, root=str(tmp_path)), merge_at=2)
    names = ("sales_table", "items_table", "acks_table", "rejects_table", "choices_table", "sketches_table", "commits_table")
    for name in names:
        setattr(intake, name, f"catalog_intake.{name}")
    for number in range(4):
        intake.take(sent(spark, number * 2, 3))
    assert counts(None, intake) == (9, 9, 9, 0)
    assert len(intake.batches()) == 1
    spark.sql("DROP SCHEMA catalog_intake CASCADE")


def test_an_empty_batch_leaves_no_trace(spark, store):
    intake = SalesIntake(store)
    intake.take(spark.createDataFrame([], "value string"))
    assert intake.batches() == [] and store.find(intake.commits_table) is None


def test_batch_and_stream_agree(spark, store, tmp_path):
    other = FolderStore(spark, str(tmp_path / "other"))
    put(spark, str(tmp_path / "in"), NESTED, FLAT)
    intake = SalesIntake(store)
    run(intake, spark, tmp_path, "one")
    again = SalesIntake(other)
    again.take(spark.read.text(str(tmp_path / "in")))
    for table in (intake.sales_table, intake.items_table):
        assert rows(intake.read(table)) == rows(again.read(table))


def test_a_batch_of_new_sales_shuffles_no_text(spark, store):
    assert "Exchange" not in plan_of(_fated(sent(spark, 0, 3), None))
    real_write, plans = store.write, {}

    def write(df, table, mode, partition_by=(), rows=None):
        gathered = _gathered(df, partition_by)
        plans[table] = gathered._jdf.queryExecution().analyzed().toString()
        real_write(df, table, mode, partition_by, rows)

    store.write = write
    intake = SalesIntake(store)
    intake.take(sent(spark, 0, 3))
    assert len(plans) == 6 and all("RebalancePartitions" not in plan for plan in plans.values())


def test_copies_among_new_sales(spark, store):
    intake = SalesIntake(store)
    batch = sent(spark, 0, 50)
    intake.take(batch.union(batch.limit(7)).union(payloads(spark, BARE.replace("F-1", "S-3"), NESTED[:-1])))
    assert counts(store, intake) == (50, 49, 50, 2)
    intake.take(sent(spark, 40, 20).union(payloads(spark, NESTED[:-1], NESTED[:-1], NESTED[:-2])))
    assert counts(store, intake) == (60, 59, 60, 3)
    assert intake.read(intake.rejects_table).filter("raw IS NULL").count() == 0


def test_executors_hold_nothing_and_passing_files_go(spark, store):
    held = spark.sparkContext._jsc.getPersistentRDDs
    real_write, seen, before = store.write, [], held().size()

    def write(df, table, mode, partition_by=(), rows=None):
        real_write(df, table, mode, partition_by, rows)
        seen.append(held().size() - before)

    store.write = write
    batch = sent(spark, 0, 5)
    SalesIntake(store).take(batch.union(batch).union(payloads(spark, BARE.replace("F-1", "S-3"), NESTED[:-1])))
    assert len(seen) == 7 and set(seen) == {0}
    assert glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/intake-batch-*") == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
