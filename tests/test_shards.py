"""Month files: discovery, enforced schema, window, reload."""

from __future__ import annotations

import pytest

from tallyloom.config import RetailConfig
from tallyloom.sources import shapes, shards

CFG = RetailConfig()
HEADER = "OrderID,CustomerID,OrderDate,OrderDiscountPct,BasketItemCount"


def month_file(folder, name, lines, header=HEADER):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


@pytest.mark.parametrize("nested", [False, True])
def test_both_layouts_are_read_within_the_window(spark, tmp_path, nested):
    folder = tmp_path / "monthly" if nested else tmp_path
    month_file(folder, "orders202212.csv", ["O0,C0,2022-12-01,0,1"])
    month_file(folder, "orders202301.csv", ["O1,C1,2023-01-01,0,1", "007,C1 ,2023-01-02,0,1"])
    month_file(folder, "Orders202302.CSV", ["O2,C1,2023-02-01,0,1"])
    month_file(folder, "orders_backup.csv", ["O9,C1,2023-02-01,0,1"])
    names = [p.rsplit("/", 1)[-1] for p in shards.shard_files(spark, str(tmp_path), "orders")]
    assert sorted(names) == sorted(["orders202212.csv", "orders202301.csv", "Orders202302.CSV"])
    rows = shards.read_month_files(spark, str(tmp_path), "orders", CFG).collect()
    assert {(r.OrderID, r.source_month) for r in rows} == {("O1", "202301"), ("007", "202301"), ("O2", "202302")}


def test_unexpected_header_is_refused(spark, tmp_path):
    month_file(tmp_path, "orders202301.csv", ["O1,C1,2023-01-01,0,1"], header=HEADER.replace("OrderDate", "Day"))
    with pytest.raises(Exception, match="header|Header|schema"):
        shards.read_month_files(spark, str(tmp_path), "orders", CFG).collect()


def test_round_trip_keeps_blanks_nulls_and_padding(spark, tmp_path):
    rows = [("O1", " C1 ", "", None, "1", "202301"), ("O2", "a,\"b", "x", "0", " ", "202302")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [*shards.RAW_SCHEMAS["orders"].fieldNames(), "source_month"]))
    shards.write_months(df, str(tmp_path / "o"))
    assert sorted(map(tuple, shards.read_months(spark, str(tmp_path / "o"), "orders", CFG).collect()), key=str) == sorted(rows, key=str)


def test_reload_replaces_months_and_purges_on_request(spark, tmp_path):
    schema = ", ".join(f"{c} string" for c in [*shards.RAW_SCHEMAS["orders"].fieldNames(), "source_month"])
    folder = str(tmp_path / "o")
    first = spark.createDataFrame([("A", "C", "d", "0", "1", "202301"), ("B", "C", "d", "0", "1", "202302")], schema)
    shards.write_months(first, folder)
    shards.write_months(spark.createDataFrame([("A2", "C", "d", "0", "1", "202301")], schema), folder)
    read = lambda: {r.OrderID for r in shards.read_months(spark, folder, "orders", CFG).collect()}
    assert read() == {"A2", "B"}
    shards.write_months(spark.createDataFrame([("A3", "C", "d", "0", "1", "202301")], schema), folder, replace_all=True)
    assert read() == {"A3"}


def test_schema_check_and_empty_source(spark, tmp_path):
    empty = shards.no_rows(spark, "items")
    assert empty.count() == 0
    assert shards.check_schema(empty, "items") is empty
    with pytest.raises(ValueError, match="Schema mismatch"):
        shards.check_schema(empty.drop("Quantity"), "items")


def test_dimensions_are_text_until_types_are_detected(spark, tmp_path):
    (tmp_path / "dim_products.csv").write_text("ProductID,RetailPrice,Made,Stock,Note\n00123,5.5,2024-01-02,7,\n4,6, 2024-1-3 ,-8,\n")
    df = shards.read_dimension(spark, str(tmp_path / "dim_products.csv"))
    assert {t for _, t in df.dtypes} == {"string"}
    typed = shapes.detected(df)
    assert dict(typed.dtypes) == {"ProductID": "string", "RetailPrice": "double", "Made": "date", "Stock": "bigint", "Note": "string"}
    assert {tuple(map(str, r)) for r in typed.collect()} == {("00123", "5.5", "2024-01-02", "7", "None"), ("4", "6.0", "2024-01-03", "-8", "None")}
