"""Cleaning rules on hand-written dirty rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from tallyloom.config import RetailConfig
from tallyloom.operators import cleaning
from tallyloom.sources.shards import RAW_SCHEMAS

CFG = RetailConfig()

ORDERS = [  # id, customer, date, discount, basket, flags, kept
    ("O1", "C1", "2024-03-05", "0.10", "2", "", True),
    (" O2", "C1 ", "2024-03-06", "0", "1", "TRIMMED_KEYS", True),
    (" O3　", "C1", "2024-3-6", "0", "1", "TRIMMED_KEYS", True),
    ("", "C1", "2024-03-07", "0.1", "1", "BLANK_ORDER_ID", False),
    ("  ", "C2", "2024-03-07", "0.1", "1", "BLANK_ORDER_ID|TRIMMED_KEYS", False),
    (None, "C2", "2024-03-07", "0.1", "1", "NULL_ORDER_ID", False),
    ("O5", None, "2024-03-07", "0.1", "1", "NULL_CUSTOMER_ID", False),
    ("O6", "\t", "2024-03-07", "0.1", "1", "BLANK_CUSTOMER_ID|TRIMMED_KEYS", False),
    ("O7", "C2", "05.03.2024", "0.1", "1", "UNPARSEABLE_DATE", False),
    ("O13", "C2", "2024", "0.1", "1", "UNPARSEABLE_DATE", False),
    ("O14", "C2", "2024-02-30", "0.1", "1", "UNPARSEABLE_DATE", False),
    ("O15", "C2", "", "0.1", "1", "BLANK_DATE", False),
    ("O16", "C2", None, "0.1", "1", "NULL_DATE", False),
    ("O8", "C2", "2027-01-01", "0.1", "1", "FUTURE_DATE", False),
    ("O9", "C2", "2019-12-31", "0.1", "1", "TOO_EARLY_DATE", False),
    ("O10", "C2", "2020-01-01", "1", "1", "", True),
    ("O11", "C2", "2026-09-30", "1.01", "1", "DISCOUNT_PCT_OUT_OF_RANGE", True),
    ("O12", "C2", "2024-05-01", "abc", "0", "UNPARSEABLE_DISCOUNT_PCT|NON_POSITIVE_BASKET_COUNT", True),
    ("O17", "C2", "2024-05-01", " ", "2.0", "BLANK_DISCOUNT_PCT|UNPARSEABLE_BASKET_COUNT", True),
    ("O18", "C2", "2024-05-01", None, "", "BLANK_BASKET_COUNT", True),
]

ITEMS = [  # quantity, price, amount, cleaned amount, flags
    ("2", "10.00", "20.00", "20.00", ""),
    ("1", "150", "1000", "1000.00", ""),
    ("1", "150", "1000.01", "10.00", "CENTS_CONVERTED"),
    ("1", "1000", "50000", "500.00", "CENTS_CONVERTED"),
    ("1", "5000.01", "50000.01", "50000.01", ""),
    ("1", "42.9", "429", "4.29", "CENTS_CONVERTED"),
    ("1", "42.9", "428.99", "428.99", ""),
    ("1", "10", "0", None, "ZERO_AMOUNT"),
    ("1", "10", "-5", None, "NEGATIVE_AMOUNT"),
    ("1", "10", "", None, "BLANK_AMOUNT"),
    ("1", "10", None, None, "NULL_AMOUNT"),
    ("1", "10", "12,50", None, "UNPARSEABLE_AMOUNT"),
    ("0", "10", "20", "20.00", "NON_POSITIVE_QUANTITY"),
    ("2.0", "10", "20", "20.00", "UNPARSEABLE_QUANTITY"),
    (None, " ", "20", "20.00", "NULL_QUANTITY|BLANK_UNIT_PRICE"),
    ("", "n/a", "20", "20.00", "BLANK_QUANTITY|UNPARSEABLE_UNIT_PRICE"),
    ("3", "-1", "20", "20.00", "NON_POSITIVE_UNIT_PRICE"),
    ("3", None, "20.005", "20.01", "NULL_UNIT_PRICE"),
]


def raw(spark, kind, rows):
    columns = RAW_SCHEMAS[kind].fieldNames() + ["source_month"]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


@pytest.fixture(scope="module")
def orders(spark):
    return raw(spark, "orders", [(*o[:5], "202403") for o in ORDERS])


@pytest.fixture(scope="module")
def items(spark):
    rows = [(f"O{i}", "1", f"P{i}", q, p, a, "202403") for i, (q, p, a, _, _) in enumerate(ITEMS)]
    return raw(spark, "items", rows)


def test_order_flags_and_kept_rows(orders):
    cleaned = cleaning.orders_cleaned(orders, CFG)
    by_raw = {(r.raw_order_id, r.raw_customer_id, r.raw_order_date): r for r in cleaned.collect()}
    kept = {r.order_id for r in cleaning.orders_validated(cleaned).collect()}
    for o in ORDERS:
        row = by_raw[o[:3]]
        assert row.cleaning_flags == o[5], o
        assert (row.order_id in kept) == o[6], o
    row = by_raw[ORDERS[2][:3]]
    assert (row.order_id, row.order_date) == ("O3", date(2024, 3, 6))
    assert by_raw[ORDERS[16][:3]].order_discount_pct is None
    assert by_raw[ORDERS[17][:3]].basket_item_count is None


def test_item_amounts_and_flags(items):
    got = {r.product_id: r for r in cleaning.items_cleaned(items, CFG).collect()}
    for i, (_, _, _, amount, flags) in enumerate(ITEMS):
        row = got[f"P{i}"]
        assert row.line_net_amount == (None if amount is None else Decimal(amount)), ITEMS[i]
        assert row.cleaning_flags == flags, ITEMS[i]


def test_incomplete_items_are_dropped(items):
    kept = {r.product_id for r in cleaning.items_validated(cleaning.items_cleaned(items, CFG)).collect()}
    assert kept == {f"P{i}" for i in range(7)}


def test_newest_month_wins_and_copies_collapse(spark):
    row = ("O1", "C1", "2024-03-05", "0.1", "1")
    later = ("O1", "C9", "2024-03-05", "0.2", "1")
    df = raw(spark, "orders", [(*row, "202403"), (*row, "202403"), (*later, "202404")])
    out = cleaning.orders_validated(cleaning.orders_cleaned(df, CFG)).collect()
    assert [(r.customer_id, r.source_month) for r in out] == [("C9", "202404")]


def test_equal_month_is_decided_by_content_key(spark):
    rows = [("O1", f"C{i}", "2024-03-05", "0.1", "1", "202403") for i in range(5)]
    cleaned = cleaning.orders_cleaned(raw(spark, "orders", rows), CFG)
    first = min(cleaned.collect(), key=lambda r: r.row_id)
    assert cleaning.orders_validated(cleaned).first().customer_id == first.customer_id


def test_row_id_keeps_nulls_and_lines_apart(spark):
    rows = [("O1", "1", None, "1", "1", "1", "202403"), ("O1", "1", "", "1", "1", "1", "202403"),
            ("O1", "2", None, "1", "1", "1", "202403"), ("O1", "1", None, "1", "1", "1", "202403")]
    ids = [r.row_id for r in cleaning.items_intake(raw(spark, "items", rows), CFG).collect()]
    assert len(set(ids)) == 3 and all(len(i) == 32 for i in ids)


def test_months_outside_the_window_are_not_read(spark):
    rows = [("O1", "C1", "2024-03-05", "0", "1", m) for m in ("202212", "202301", "202608", "202609")]
    got = {r.source_month for r in cleaning.orders_intake(raw(spark, "orders", rows), CFG).collect()}
    assert got == {"202301", "202608"}
    assert RetailConfig(include_open_month=True).end_month == "202609"
    assert RetailConfig(as_of_date=date(2026, 1, 5)).end_month == "202512"


def test_log_lists_flags_in_order(spark, orders, items):
    oc, ic = cleaning.orders_cleaned(orders, CFG), cleaning.items_cleaned(items, CFG)
    log = cleaning.cleaning_log(oc, cleaning.orders_validated(oc), ic, cleaning.items_validated(ic)).orderBy("entry_order").collect()
    assert log[0].finding == (
        f"Orders: {len(ORDERS)} intake -> 8 validated (40% retention). "
        f"Items: {len(ITEMS)} intake -> 7 validated (38.89% retention)."
    )
    names = [r.rule_name for r in log[1:]]
    assert names == sorted(names) and "items: CENTS_CONVERTED" in names
    assert [r.entry_order for r in log] == list(range(len(log)))
    assert {r.finding for r in log if r.rule_name == "items: CENTS_CONVERTED"} == {"3 rows flagged in items stream."}
