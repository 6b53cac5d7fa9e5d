"""Shards of different shapes: headers, types, alignment by name, the guarded audit."""

from __future__ import annotations

import dataclasses

import pytest

from tallyloom.config import RetailConfig
from tallyloom.operators import audit
from tallyloom.plans.build import RawTables, Shop
from tallyloom.sources import shapes

CFG = RetailConfig()
ORDERS = "OrderID,CustomerID,OrderDate,OrderDiscountPct,BasketItemCount"
ITEMS = "OrderID,LineNumber,ProductID,Quantity,UnitPrice,LineNetAmount"


def put(folder, name, header, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def order_lines(month, n=12, day="2023-01-{:02d}"):
    return [f"O{month}{i},C{i % 3},{day.format(i + 1)},0.1,2" for i in range(n)]


@pytest.fixture
def folder(tmp_path):
    put(tmp_path, "orders202301.csv", ORDERS, order_lines(1))
    put(tmp_path / "nested", "Orders202302.CSV", "﻿CustomerID,OrderID,\"OrderDate\",BasketItemCount,Extra", [f"C{i},\"O2,{i}\",2023-02-01,2,x" for i in range(12)])
    put(tmp_path, "orders202303.csv", ORDERS, order_lines(3, day="202303{:02d}"))
    put(tmp_path, "orders202304.csv", "a;b", ["1;2"])
    put(tmp_path, "orders202212.csv", ORDERS, order_lines(9))  # before the window
    put(tmp_path, "orders202305.csv", ORDERS, ["OrderID,CustomerID,x,,"] + order_lines(5, 3))  # a data row that looks like a header
    put(tmp_path, "items202301.csv", ITEMS, [f"O1{i},1,P{i % 2},{i + 1},2.50,{2.5 * (i + 1)}" for i in range(12)])
    return str(tmp_path)


def test_inventory_reads_every_shard(spark, folder):
    found = shapes.shapes(spark, folder, "orders", CFG)
    assert sorted((len(s.columns), s.months) for s in found) == [(0, ("202304",)), (5, ("202301", "202303", "202305")), (5, ("202302",))]
    rows = {(r.table_name, r.column_name): (r.data_type, r.ordinal_position) for r in shapes.inventory(spark, found, "orders").collect()}
    assert rows[("orders202301", "OrderDate")] == ("date", 3) and rows[("orders202303", "OrderDate")] == ("bigint", 3)
    assert rows[("orders202302", "OrderID")] == ("string", 2) and rows[("orders202302", "Extra")] == ("string", 5)
    assert ("orders202302", "OrderDiscountPct") not in rows and rows[("orders202304", None)] == (None, None)
    assert rows[("orders202305", "OrderDate")] == (None, 3)  # too few values to tell
    contract = audit.schema_contract(shapes.inventory(spark, found, "orders"), "orders", audit.ORDER_HEADERS, CFG).first()
    assert (contract.shards, contract.shards_missing_columns, contract.columns_with_type_drift, contract.contract_ok) == (5, 2, 1, False)


def test_shapes_are_aligned_by_name(spark, folder):
    rows = shapes.read_shapes(spark, shapes.shapes(spark, folder, "orders", CFG), "orders").collect()
    by = {}
    for r in rows:
        by.setdefault(r.source_month, []).append(r)
    assert {m: len(x) for m, x in by.items()} == {"202301": 12, "202302": 12, "202303": 12, "202305": 4}
    assert {(r.OrderID, r.CustomerID, r.OrderDate, r.OrderDiscountPct, r.BasketItemCount) for r in by["202302"]} == {
        (f"O2,{i}", f"C{i}", "2023-02-01", None, "2") for i in range(12)}


def test_guarded_audit_skips_and_counts(spark, folder):
    cfg = dataclasses.replace(CFG)
    customers = spark.createDataFrame([("C1",)], "CustomerID string")
    products = spark.createDataFrame([("P1",)], "ProductID string")
    shop = Shop(spark, folder, RawTables(None, None, customers, products), cfg)
    found = {kind: shapes.shapes(spark, folder, kind, cfg) for kind in ("orders", "items")}
    rows = {r.check_order: r for r in shop.audit_of(found, shop._inventory(found)).collect()}
    assert [(rows[c].issue_count, rows[c].table_rows) for c in (5, 6, 7, 8)] == [(2, 5), (1, 5), (0, 1), (0, 5)]
    assert all(rows[c].issue_count is None and rows[c].handling.startswith("Skipped") for c in range(13, 20))
    assert [(rows[c].issue_count, rows[c].table_rows) for c in (25, 27)] == [(6, 12), (0, 12)]
    sentence = {r.check_order: r.finding for r in audit.audit_findings(shop.audit_of(found, shop._inventory(found))).collect()}
    assert sentence[13].startswith("NULL OrderID – Skipped. ")
    shop.close()


def test_one_month_in_two_shapes_has_what_both_have(spark, tmp_path):
    put(tmp_path / "source_month=202301", "part-0.csv", ORDERS, order_lines(1))
    put(tmp_path / "source_month=202301", "part-1.csv", ORDERS.replace("OrderDate,", ""), ["O1,C1,0.1,1"])
    found = shapes.shapes(spark, str(tmp_path), "orders", CFG)
    names = {r.column_name for r in shapes.inventory(spark, found, "orders").collect()}
    assert names == {"OrderID", "CustomerID", "OrderDiscountPct", "BasketItemCount"}
    assert shapes.read_shapes(spark, found, "orders").count() == 13


def test_empty_folder(spark, tmp_path):
    put(tmp_path, "items202301.csv", ITEMS, [])
    assert shapes.shapes(spark, str(tmp_path), "orders", CFG) == []
    assert shapes.read_shapes(spark, [], "orders").count() == 0
    assert shapes.inventory(spark, [], "orders").count() == 0
    listed = shapes.inventory(spark, shapes.shapes(spark, str(tmp_path), "items", CFG), "items").collect()
    assert {(r.table_name, r.data_type) for r in listed} == {("items202301", None)} and len(listed) == 6
