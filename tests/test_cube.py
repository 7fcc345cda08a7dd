from __future__ import annotations

from datetime import date, datetime

import pytest
from samples import line, rows, sale, tables

from tillmart.plans import cube, marts, worksheets
from tillmart.plans.cube import Cube, cube_rows, write_cube

DAYS = [[date(2025, 9, 1)], [date(2025, 9, 1), date(2025, 10, 2)], [date(1999, 1, 1)], [], None]


@pytest.fixture
def lines(spark):
    at = [datetime(2025, 9, 1, 8), datetime(2025, 9, 1, 23, 59), datetime(2025, 10, 2), None]
    sales = [
        sale(str(n), "AB"[n % 2] if n % 7 else None, None if n % 11 == 0 else f"c{n % 13}", at=at[n % 4])
        for n in range(150)
    ]
    sales.append(sale("0", "A", "c1", at=at[2]))  # one id on two days
    items = [line(f"i{n}", str(n * 7 % 151), None if n % 17 == 0 else f"p{n % 3}", quantity=n % 5 or None) for n in range(400)]
    return marts.mart_rows(marts.SALES_FULL, *tables(spark, sales, items))


@pytest.mark.parametrize("days", DAYS)
def test_sheets_from_the_cube_equal_those_from_the_lines(store, lines, days):
    write_cube(lines, store)
    found, wanted = Cube.read(store).dashboard(days), worksheets.dashboard(lines, days)
    assert set(found) == set(wanted)
    for sheet, df in wanted.items():
        assert found[sheet].columns == df.columns
        assert [f.dataType for f in found[sheet].schema] == [f.dataType for f in df.schema]
        assert rows(found[sheet]) == rows(df)


def test_a_selection_reads_the_cube_only(store, lines):
    write_cube(lines, store)
    for sheet in Cube.read(store).dashboard([date(2025, 10, 2)]).values():
        assert sheet.inputFiles() and all("/sales_cube" in name for name in sheet.inputFiles())
    plan = Cube.read(store).kpis([date(2025, 10, 2)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_month" in plan or "sale_month" in plan.split("PartitionFilters")[1]


def test_numbers_fill_words(store, spark):
    sales = [sale(f"{n:04d}", "A", f"c{n % 100}", at=datetime(2025, 9, 1 + n // 500)) for n in range(1000)]
    flat = marts.mart_rows(marts.SALES_FULL, *tables(spark, sales, [line(f"i{n}", f"{n:04d}") for n in range(1000)]))
    _, members = cube_rows(flat)
    held = members.groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in held} == {"customers": 4, "transactions": 17}


def test_no_lines(lines):
    cube = Cube(*cube_rows(lines.limit(0)))
    assert tuple(cube.kpis().first()) == (None, None, 0, 0)
    assert cube.product_performance().collect() == []


def test_lines_are_worked_out_once(store, lines, monkeypatch):
    read = []
    monkeypatch.setattr(cube, "cube_rows", lambda rows: read.append(rows) or cube_rows(rows))
    write_cube(lines, store)
    assert read[0].inputFiles() and all("/cube-lines-" in name for name in read[0].inputFiles())
