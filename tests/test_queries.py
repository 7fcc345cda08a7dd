"""Every registered query against its SQL."""

from __future__ import annotations

import __spark_entry__ as driver
import oracle
import pytest
from conftest import DATA


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(DATA)


def test_every_query_has_sql():
    assert set(driver.sales_queries()) == set(driver.sales_sql())


@pytest.mark.parametrize("name", sorted(driver.sales_queries()))
def test_query_equals_sql(spark, connection, name):
    columns, found = oracle.spark_bag(driver.queries()[name](spark, DATA))
    wanted_columns, wanted = oracle.duck_bag(connection, driver.oracle_sql()[name])
    assert columns == wanted_columns
    assert found == wanted
    assert sum(found.values()) > 0


def test_entry_is_ordered_by_product_total(spark):
    rows = driver.entry(spark).collect()
    totals = {}
    for row in rows:
        totals[row.product_name] = totals.get(row.product_name, 0) + row.total_sales
    seen = list(dict.fromkeys(row.product_name for row in rows))
    assert seen == sorted(totals, key=lambda name: (-totals[name], name))


def test_presentation_order_of_marts(spark):
    top = driver.queries()["dm_top_selling_products"](spark, DATA).collect()
    assert [(-r.total_sold, r.product_name) for r in top] == sorted(
        (-r.total_sold, r.product_name) for r in top
    )
    months = [r.month for r in driver.queries()["dm_sales_trend"](spark, DATA).collect()]
    assert months == sorted(months)
