"""Audits, contracts, findings and coverage assertions."""

from __future__ import annotations

from datetime import date

import pytest

from tallyloom.config import RetailConfig
from tallyloom.operators import audit
from tallyloom.operators.dimensions import CUSTOMER_COLUMNS, PRODUCT_COLUMNS
from tallyloom.sources import shapes
from tallyloom.sources.shards import RAW_SCHEMAS

CFG = RetailConfig()


def text_frame(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def listed(spark, df, prefix):
    """A table per month with the columns of df."""
    fields = [f for f in df.schema.fields if f.name != "source_month"]
    rows = [(f"{prefix}{m[0]}", f.name, "string", at) for m in df.select("source_month").distinct().collect() for at, f in enumerate(fields, 1)]
    return spark.createDataFrame(rows, shapes.INVENTORY)


def source(spark, order_columns=None, customer_columns=CUSTOMER_COLUMNS):
    orders = text_frame(spark, [*RAW_SCHEMAS["orders"].fieldNames(), "source_month"], [
        ("O1", "C1", "2024-03-05", "0.1", "1", "202403"), (" O2", "C7", "x", "0.1", "1", "202403"),
        (None, " ", "", "0", "1", "202403"), ("O4", "C1", "2027-01-01", "0", "1", "202404")])
    items = text_frame(spark, [*RAW_SCHEMAS["items"].fieldNames(), "source_month"], [
        ("O1", "1", "P1", "1", "10", "10", "202403"), ("O1", "2", "P1", "1", "10", "10", "202403"),
        ("O2", "1", "P9", "1", "10", "-1", "202403"), ("O2", "2", None, "1", "10", "0", "202403"),
        ("O3", "1", "P1 ", "1", "10", "abc", "202403"), ("O4", "1", "P1", "1", "10", "1500", "202404"),
        (None, "1", "P1", "1", "10", "", "202404")])
    customers = text_frame(spark, customer_columns, [tuple("C1" if c == "CustomerID" else "v" for c in customer_columns)] * 2)
    products = text_frame(spark, PRODUCT_COLUMNS, [("P1",) + ("v",) * 6, (" ",) + ("v",) * 6])
    inventory = listed(spark, orders, "orders").unionByName(listed(spark, items, "items"))
    if order_columns is not None:
        inventory = inventory.filter(f"NOT (table_name = 'orders202404' AND column_name = '{order_columns}')")
    return audit.RawSource(orders, items, customers, products, inventory)


def test_raw_audit_counts(spark):
    rows = {r.check_order: r for r in audit.raw_audit(source(spark), CFG).collect()}
    assert sorted(rows) == list(range(1, 30))
    got = {k: r.issue_count for k, r in rows.items()}
    assert [got[k] for k in range(1, 9)] == [0] * 8
    assert (got[9], got[10], got[11], got[12]) == (0, 1, 1, 0)
    assert [got[k] for k in range(13, 20)] == [1, 1, 1, 1, 1, 1, 2]
    # 27: one repeated pair, and the row whose product is NULL
    assert [got[k] for k in range(20, 28)] == [1, 1, 1, 1, 1, 1, 1, 2]
    assert rows[15].table_rows == 4 and float(rows[15].pct_of_table) == 25.0
    assert (rows[28].issue_count, rows[29].issue_count) == (2, 2)


def test_broken_contract_skips_the_source_only(spark):
    rows = {r.check_order: r for r in audit.raw_audit(source(spark, order_columns="OrderDate"), CFG).collect()}
    assert rows[5].issue_count == 1 and rows[5].table_rows == 2
    for check in range(13, 20):
        assert rows[check].issue_count is None and rows[check].pct_of_table is None
        assert rows[check].handling.startswith("Skipped")
    assert rows[20].issue_count == 1
    findings = {r.check_order: r.finding for r in audit.audit_findings(audit.raw_audit(source(spark, order_columns="OrderDate"), CFG)).collect()}
    assert findings[13] == "NULL OrderID – Skipped. Skipped because orders wildcard contract is broken"
    assert findings[28] == "dim_customers row count – 2 rows."
    assert findings[20] == "Found 1 for Negative LineNetAmount (14.286%) – Exclude during cleaning because negative revenue is treated as miscoded returns"


def test_missing_lookup_header_skips_its_checks(spark):
    columns = tuple(c for c in CUSTOMER_COLUMNS if c != "CustomerID") + ("Extra",)
    rows = {r.check_order: r for r in audit.raw_audit(source(spark, customer_columns=columns), CFG).collect()}
    assert (rows[1].issue_count, rows[2].issue_count) == (1, 1)
    assert rows[9].issue_count is None and rows[10].issue_count is None and rows[15].issue_count is None
    assert rows[13].issue_count == 1


def test_type_drift_breaks_the_contract(spark):
    inventory = spark.createDataFrame(
        [("orders202301", c, "string", 1) for c in audit.ORDER_HEADERS] + [("orders202302", c, "string" if c != "OrderID" else "bigint", 1) for c in audit.ORDER_HEADERS]
        + [("orders209901", "OrderID", "string", 1)],
        "table_name string, column_name string, data_type string, ordinal_position int")
    row = audit.schema_contract(inventory, "orders", audit.ORDER_HEADERS, CFG).first()
    assert (row.shards, row.shards_missing_columns, row.columns_with_type_drift, row.contract_ok) == (2, 0, 1, False)


def coverage_tables(spark):
    curated = spark.createDataFrame([("DE",), ("AT",), (None,)], "country string")
    segments = spark.createDataFrame([("DE",), ("AT",)], "primary_country string")
    customers = spark.createDataFrame([("DE",), ("AT",), ("CH",)], "country string")
    return curated, segments, customers


@pytest.mark.parametrize("fault,message", [
    ("empty_curated", "holds no country"), ("extra_curated_country", "missing from rfm_customer_segments"),
    ("segment_country_missing_from_dimension", "missing from the customer dimension")])
def test_each_fault_trips_its_own_check(spark, fault, message):
    with pytest.raises(AssertionError, match=message):
        audit.assert_country_coverage(*coverage_tables(spark), fault=fault)


def test_no_fault_passes_and_unknown_fault_is_refused(spark):
    audit.assert_country_coverage(*coverage_tables(spark))
    with pytest.raises(ValueError, match="unknown fault"):
        audit.assert_country_coverage(*coverage_tables(spark), fault="other")


def test_clean_audit_uses_the_given_day(spark):
    orders = spark.createDataFrame([("O1", "C1", date(2024, 1, 5), None, 2), ("O2", "C8", date(2024, 1, 9), None, 1)],
                                   "order_id string, customer_id string, order_date date, order_discount_pct decimal(10,9), basket_item_count bigint")
    items = spark.createDataFrame([("O1", "P1", 1, 1.0, 1.0), ("O3", "P7", 1, 1.0, 1.0)], "order_id string, product_id string, quantity bigint, unit_price double, line_net_amount double")
    customers = spark.createDataFrame([("C1",)], "customer_id string")
    products = spark.createDataFrame([("P1", 1.0), (None, None)], "product_id string, unit_cost double")
    totals = spark.createDataFrame([("O1", 1), ("O3", 1)], "order_id string, line_count bigint")
    got = {r.check_order: r.issue_count for r in audit.clean_audit(orders, items, customers, products, totals, date(2024, 1, 7)).collect()}
    assert [got[k] for k in range(1, 10)] == [0, 0, 1, 0, 1, 0, 1, 1, 0]
    assert (got[12], got[13], got[20], got[23], got[25], got[26]) == (1, 1, 0, 1, 1, 2)


def test_column_inventory_and_enriched_dimension(spark):
    df = spark.createDataFrame([("C1", "s"), ("C2", None)], "customer_id string, segment string")
    listed = audit.column_inventory(spark, {"dim": df}).orderBy("ordinal_position").collect()
    assert [(r.column_name, r.data_type, r.ordinal_position) for r in listed] == [("customer_id", "string", 1), ("segment", "string", 2)]
    row = audit.customer_dim_validation(df, df).first()
    assert (row.row_delta, row.dup_delta, row.null_segment_customers, row.scored_customers) == (0, 0, 1, 1)
