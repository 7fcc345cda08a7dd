from __future__ import annotations

import json
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from samples import line, sale, tables

from tillmart.operators.documents import document_json, item_arrays, requested_documents, sale_documents
from tillmart.operators.lookup import header_lookup, items_lookup


@pytest.fixture(scope="module")
def both(spark):
    return tables(
        spark,
        [sale("1", name="B"), sale("1", name="A"), sale("2", gender=None), sale("3", at=datetime(2025, 1, 1, 2, 3, 4))],
        [line("b", "1"), line("a", "1"), line("a", "1"), line("x", "9"), line("c", "3", None, None, None)],
    )


def texts(documents, key):
    return {
        r[0]: json.loads(r[1]) for r in documents.select(key, document_json(documents)).collect()
    }


def test_documents(both):
    found = texts(sale_documents(*both), "transactionId")
    assert sorted(found) == ["1", "2", "3"]
    assert [i["itemId"] for i in found["1"]["items"]] == ["a", "a", "b"]
    assert found["1"]["customerName"] == "A"
    assert found["2"]["items"] == [] and found["2"]["customerGender"] is None
    assert found["3"]["items"] == [{"itemId": "c", "name": None, "price": None, "quantity": None}]
    assert found["3"]["transactionDate"] == "2025-01-01T02:03:04"
    assert list(found["1"]) == [
        "transactionId", "source", "customerName", "deliveryAddress", "customerAge",
        "customerGender", "customerContact", "items", "totalAmount", "paymentType", "transactionDate",
    ]


def test_requested_documents(spark, both):
    wanted = spark.createDataFrame([("1",), ("9",), ("7",), ("1",)], "transaction_id string")
    found = texts(requested_documents(*both, wanted), "requested_id")
    assert sorted(found) == ["1", "7", "9"]
    assert found["7"]["items"] == [] and found["7"]["transactionId"] is None
    assert [i["itemId"] for i in found["9"]["items"]] == ["x"]
    assert found["9"]["source"] is None and found["9"]["totalAmount"] is None


def test_lines_are_dealt_to_parts(spark):
    items = (
        [line(f"i{n}", "big") for n in range(300)]
        + [line("same", "big")] * 250
        + [line("s", "small")] * 3
    )
    sales, lines = tables(spark, [sale("big"), sale("small"), sale("none")], items)
    lines = lines.union(spark.createDataFrame([line("lost", None)], lines.schema))
    parts = sale_documents(sales, lines, parts=8).select("transactionId", "part", "items").collect()
    assert sorted(p.part for p in parts if p.transactionId == "big") == list(range(8))
    assert [len(p["items"]) for p in parts if p.transactionId == "small"] == [3]
    assert [(p.part, len(p["items"])) for p in parts if p.transactionId == "none"] == [(0, 0)]
    found = Counter(i.itemId for p in parts if p.transactionId == "big" for i in p["items"])
    assert found == Counter([f"i{n}" for n in range(300)] + ["same"] * 250)
    whole = sale_documents(sales, lines).select("transactionId", "part", F.size("items")).collect()
    assert sorted(map(tuple, whole)) == [("big", 0, 550), ("none", 0, 0), ("small", 0, 3)]
    # The same parts again when computed again.
    again = item_arrays(lines, 8).select(F.xxhash64("transaction_id", "part", "items")).collect()
    assert sorted(again) == sorted(
        item_arrays(lines.repartition(3), 8).select(F.xxhash64("transaction_id", "part", "items")).collect()
    )
    assert item_arrays(lines).filter("transaction_id IS NULL").count() == 0


def test_building_documents_starts_no_job(spark, both):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("documents", "building")
    sale_documents(*both, parts=3)
    assert len(tracker.getJobIdsForGroup("documents")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lookups(spark, both):
    sales, items = both
    assert [r.customer_name for r in header_lookup(sales, "2").collect()] == ["Ann"]
    assert header_lookup(sales, ["1", "3", "7"]).count() == 3
    assert items_lookup(items, "9").columns == ["transaction_id", "item_id", "product_name", "price", "quantity"]
    wanted = spark.createDataFrame([("1",), ("1",)], "transaction_id string")
    assert items_lookup(items, wanted).count() == 3


def test_lookup_by_id_reaches_the_scan(store, both):
    store.write(both[0], "s", "overwrite")
    plan = header_lookup(store.read("s"), "2")._jdf.queryExecution().toString()
    assert "EqualTo(transaction_id,2)" in plan
    plan = header_lookup(store.read("s"), ["2", "3"])._jdf.queryExecution().toString()
    assert "In(transaction_id, [2,3])" in plan


def test_lines_of_documents_are_shuffled_once(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    documents = sale_documents(*tables(spark, [sale("1")], [line("i", "1")]))
    assert documents._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
