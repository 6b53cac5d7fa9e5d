"""Data-quality audits of the raw and the cleaned layer, and hard assertions.

All counters of a source come from one scan; orphans and duplicates take one
more each, over their key columns only, and are counted from per-key counts, so
no check brings the rows of one key together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.config import RetailConfig
from tallyloom.functions.numeric import rounded_ratio
from tallyloom.functions.text import iso_date, trimmed
from tallyloom.operators.checks import (
    CLEAN_CHECKS, COVERAGE_FAULTS, COVERAGE_MESSAGES, FOREIGN_COUNTRY, RAW_CHECKS,
)
from tallyloom.operators.cleaning import cents_line, in_window
from tallyloom.operators.dimensions import CUSTOMER_COLUMNS, PRODUCT_COLUMNS

ORDER_HEADERS = ("OrderID", "CustomerID", "OrderDate", "OrderDiscountPct", "BasketItemCount")
ITEM_HEADERS = ("OrderID", "ProductID", "Quantity", "UnitPrice", "LineNetAmount")

_COUNTS = "check_order int, issue_count bigint, table_rows bigint"
_INVENTORY = "table_name string, column_name string, data_type string, ordinal_position int"


def _text(c: str) -> Column:
    return F.col(c).cast("string")


# --- schema contract --------------------------------------------------------

def column_inventory(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, type, position) of every table, from the schemas alone."""
    rows = [
        (name, f.name, f.dataType.simpleString(), at)
        for name, df in tables.items() for at, f in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, _INVENTORY)


def _shards(inventory: DataFrame, prefix: str, cfg: RetailConfig) -> DataFrame:
    month = F.regexp_extract("table_name", rf"^{prefix}(\d+)$", 1)
    return inventory.filter((month != "") & month.between(cfg.start_month, cfg.end_month))


def schema_contract(inventory: DataFrame, prefix: str, expected: Sequence[str], cfg: RetailConfig) -> DataFrame:
    """Shards, shards with a missing column, and columns with several types. One row."""
    shards = _shards(inventory, prefix, cfg)
    wanted = F.when(F.col("column_name").isin(*expected), F.col("column_name"))
    per_shard = shards.groupBy("table_name").agg(F.countDistinct(wanted).alias("have")).agg(
        F.count("*").alias("shards"),
        F.count_if(F.col("have") < len(expected)).alias("shards_missing_columns"),
    )
    drift = (
        shards.filter(F.col("column_name").isin(*expected))
        .groupBy("column_name").agg(F.countDistinct("data_type").alias("types"))
        .agg(F.count_if(F.col("types") > 1).alias("columns_with_type_drift"))
    )
    return per_shard.crossJoin(F.broadcast(drift)).select(
        F.lit(prefix).alias("source"), "*",
        F.expr("shards_missing_columns = 0 and columns_with_type_drift = 0").alias("contract_ok"),
    )


# --- raw audit --------------------------------------------------------------

@dataclass(frozen=True)
class RawSource:
    """What the raw audit reads: the four tables and the shard inventory.

    With ``parts``, lines are dealt by key into that many partitions before they are counted,
    so that a task counts its share of the keys only, however large the input's files are.
    """

    orders: DataFrame
    items: DataFrame
    customers: DataFrame
    products: DataFrame
    inventory: DataFrame
    parts: int | None = None


def _as_rows(one_row: DataFrame, checks: dict[int, tuple[str, str]]) -> DataFrame:
    """Counters of a one-row frame as (check_order, issue_count, table_rows)."""
    parts = ", ".join(
        f"{order}, cast({issue} as bigint), cast({rows} as bigint)"
        for order, (issue, rows) in checks.items()
    )
    return one_row.selectExpr(f"stack({len(checks)}, {parts}) as (check_order, issue_count, table_rows)")


def _orphan_rows(
    keys: DataFrame, key: str, lookup: DataFrame, lookup_key: str, rows: Column | None = None, sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Rows whose non-blank key is not in the lookup, from per-key row counts.

    Rows are counted per key as written, and only the distinct keys are trimmed;
    ``rows`` says how many a row of ``keys`` stands for, one if not given.
    ``sums`` are further counts over ``keys``, taken on the way.
    The join is an outer one, because an anti join would be pushed below the
    counts and meet every row of a hot key.
    """
    clean, sums = lambda c: F.nullif(trimmed(_text(c)), F.lit("")), sums or {}
    counted = keys.groupBy(F.col(key).alias("_raw")).agg(
        (F.count("*") if rows is None else F.sum(rows)).alias("n"), *[c.alias(name) for name, c in sums.items()]
    )
    known = lookup.select(clean(lookup_key).alias("_known")).filter("_known IS NOT NULL").distinct()
    missing = F.when(F.col("_key").isNotNull() & F.col("_known").isNull(), F.col("n"))
    return counted.withColumn("_key", clean("_raw")).join(known, F.col("_key") == F.col("_known"), "left").agg(
        F.coalesce(F.sum(missing), F.lit(0)).alias("orphans"), *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums]
    )


def _lookup_checks(raw: DataFrame, column: str, present: bool, first: int, count_check: int) -> DataFrame:
    """NULL keys, repeated keys and row count of a dimension."""
    key = F.nullif(trimmed(_text(column)), F.lit("")) if present else F.lit(None).cast("string")
    one = raw.select(key.alias("k")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("k").isNull()).alias("nulls"),
        (F.count("k") - F.countDistinct("k")).alias("repeats"),
    )
    return _as_rows(one, {
        first: ("nulls" if present else "null", "n"),
        first + 1: ("repeats" if present else "null", "n"),
        count_check: ("n", "n"),
    })


def _header_checks(raw: DataFrame, expected: tuple[str, ...], first: int) -> list[tuple]:
    have = set(raw.columns)
    missing = len([c for c in expected if c not in have])
    extra = len([c for c in have if c not in expected])
    return [(first, missing, len(expected)), (first + 1, extra, len(have))]


def raw_audit(src: RawSource, cfg: RetailConfig) -> DataFrame:
    """29 checks on the raw layer.

    A check on a source whose header contract is broken reports NULL issues and
    says it was skipped; the rest of the audit still runs.
    """
    spark = src.orders.sparkSession
    both = schema_contract(src.inventory, "orders", ORDER_HEADERS, cfg).unionByName(
        schema_contract(src.inventory, "items", ITEM_HEADERS, cfg)
    )
    contracts = {row["source"]: row for row in both.collect()}  # two rows
    orders_ok, items_ok = contracts["orders"]["contract_ok"], contracts["items"]["contract_ok"]
    customers_ok = "CustomerID" in src.customers.columns
    products_ok = "ProductID" in src.products.columns

    schema_rows = _header_checks(src.customers, CUSTOMER_COLUMNS, 1)
    schema_rows += _header_checks(src.products, PRODUCT_COLUMNS, 3)
    for first, prefix, expected in ((5, "orders", ORDER_HEADERS), (7, "items", ITEM_HEADERS)):
        found = contracts[prefix]
        schema_rows.append((first, found["shards_missing_columns"], found["shards"]))
        schema_rows.append((first + 1, found["columns_with_type_drift"], len(expected)))

    parts = [
        spark.createDataFrame(schema_rows, _COUNTS),
        _lookup_checks(src.customers, "CustomerID", customers_ok, 9, 28),
        _lookup_checks(src.products, "ProductID", products_ok, 11, 29),
        _raw_order_checks(src, cfg, customers_ok) if orders_ok
        else spark.createDataFrame([(c, None, 0) for c in range(13, 20)], _COUNTS),
        _raw_item_checks(src, cfg, products_ok) if items_ok
        else spark.createDataFrame([(c, None, 0) for c in range(20, 28)], _COUNTS),
    ]
    literals = spark.createDataFrame(
        RAW_CHECKS,
        "check_order int, check_name string, source_column string, severity string, _done string, _skipped string",
    )
    counts = reduce(DataFrame.unionByName, parts)
    handling = F.when(F.col("issue_count").isNull(), F.col("_skipped")).otherwise(F.col("_done"))
    pct = F.when(F.col("table_rows") > 0, rounded_ratio(F.col("issue_count") * 100, F.col("table_rows"), 3))
    return _audit_table(counts, literals, handling, pct)


def _audit_table(counts: DataFrame, literals: DataFrame, handling: Column, pct: Column) -> DataFrame:
    # Both sides have 29 rows.
    return counts.join(F.broadcast(literals), "check_order").select(
        "check_order", "check_name", "source_column", "severity", "issue_count", "table_rows",
        pct.alias("pct_of_table"), handling.alias("handling"),
        F.current_timestamp().alias("audit_run_at"),
    ).orderBy("check_order")


def _raw_order_checks(src: RawSource, cfg: RetailConfig, customers_ok: bool) -> DataFrame:
    rows = in_window(src.orders, cfg).select(
        _text("OrderID").alias("o"), _text("CustomerID").alias("c"), _text("OrderDate").alias("d"),
    ).select(
        "*", trimmed(F.col("o")).alias("to"), trimmed(F.col("c")).alias("tc"), trimmed(F.col("d")).alias("td"),
    ).withColumn("day", iso_date(F.col("td")))
    gone = lambda t: F.coalesce(F.col(t), F.lit("")) == ""
    one = rows.agg(
        F.count("*").alias("n"),
        F.count_if(gone("to")).alias("no_order"),
        F.count_if(gone("tc")).alias("no_customer"),
        F.count_if(gone("td")).alias("no_date"),
        F.count_if(~gone("td") & F.col("day").isNull()).alias("bad_date"),
        F.count_if(F.col("day") > F.lit(cfg.as_of_date)).alias("future"),
        F.count_if((F.col("o") != F.col("to")) | (F.col("c") != F.col("tc"))).alias("padded"),
    )
    if customers_ok:
        one = one.crossJoin(F.broadcast(_orphan_rows(rows, "c", src.customers, "CustomerID")))
    else:
        one = one.withColumn("orphans", F.lit(None).cast("bigint"))
    return _as_rows(one, {
        13: ("no_order", "n"), 14: ("no_customer", "n"), 15: ("orphans", "n"), 16: ("no_date", "n"),
        17: ("bad_date", "n"), 18: ("future", "n"), 19: ("padded", "n"),
    })


def _raw_item_checks(src: RawSource, cfg: RetailConfig, products_ok: bool) -> DataFrame:
    rows = in_window(src.items, cfg).select(
        "source_month", _text("OrderID").alias("o"), _text("ProductID").alias("p"),
        trimmed(_text("LineNetAmount")).alias("ta"), trimmed(_text("Quantity")).alias("tq"),
        trimmed(_text("UnitPrice")).alias("tu"),
    ).select(
        "source_month", "o", "p", "ta", trimmed(F.col("o")).alias("to"), trimmed(F.col("p")).alias("tp"),
        F.col("ta").try_cast("decimal(38,9)").alias("amount"),
        F.col("tq").try_cast("bigint").alias("quantity"),
        F.col("tu").try_cast("decimal(38,9)").alias("price"),
    )
    amount = F.col("amount")
    no_amount = F.coalesce(F.col("ta"), F.lit("")) == ""
    one = rows.agg(
        F.count("*").alias("n"),
        F.count_if(amount < 0).alias("negative"),
        F.count_if(amount == 0).alias("zero"),
        F.count_if(no_amount).alias("no_amount"),
        F.count_if(~no_amount & amount.isNull()).alias("bad_amount"),
        F.count_if(cents_line(cfg, amount, F.col("quantity"), F.col("price"))).alias("cents"),
        F.count_if((F.col("o") != F.col("to")) | (F.col("p") != F.col("tp"))).alias("padded"),
        F.count("o").alias("with_order"),
    )
    # A NULL product makes the key NULL, so such rows all count as repeats. The rows per key
    # serve the repeats and, summed per product, the orphans: lines are shuffled once.
    keys = rows.select("o", "p", "source_month")
    if src.parts is not None:
        keys = keys.repartition(src.parts, "o", "p", "source_month")
    per_key = keys.groupBy("o", "p", "source_month").agg(F.count("*").alias("lines"))
    whole = F.count_if(F.col("o").isNotNull() & F.col("p").isNotNull() & F.col("source_month").isNotNull())
    if products_ok:
        one = one.crossJoin(F.broadcast(_orphan_rows(per_key, "p", src.products, "ProductID", F.col("lines"), {"keys": whole})))
    else:
        one = one.crossJoin(F.broadcast(per_key.agg(whole.alias("keys")))).withColumn("orphans", F.lit(None).cast("bigint"))
    return _as_rows(one, {
        20: ("negative", "n"), 21: ("zero", "n"), 22: ("no_amount", "n"), 23: ("bad_amount", "n"),
        24: ("cents", "n"), 25: ("orphans", "n"), 26: ("padded", "n"), 27: ("with_order - keys", "n"),
    })


# --- clean audit ------------------------------------------------------------

def clean_audit(
    orders: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame,
    totals: DataFrame, today: date | None = None,
) -> DataFrame:
    """29 checks on the validated layer. ``totals`` is order_totals of the items.

    The future-date check reads the wall clock unless ``today`` is given.
    """
    now = F.current_date() if today is None else F.lit(today)
    pct = F.col("order_discount_pct")
    order_part = orders.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("order_id").isNull()).alias("no_order"),
        F.count_if(F.col("customer_id").isNull()).alias("no_customer"),
        F.count_if(F.col("order_date").isNull()).alias("no_date"),
        F.count_if(F.col("order_date") > now).alias("future"),
        F.count_if((pct < 0) | (pct > 1)).alias("bad_pct"),
        (F.count("*") - F.countDistinct("order_id")).alias("repeats"),
    ).crossJoin(F.broadcast(_orphan_rows(orders, "customer_id", customers, "customer_id")))

    # Orders against items at order grain: one row per order on both sides.
    met = orders.select("order_id", "basket_item_count").join(
        totals.select(F.col("order_id").alias("_order"), "line_count"), F.col("order_id") == F.col("_order"), "full"
    ).agg(
        F.count_if(F.col("order_id").isNotNull() & F.col("_order").isNull()).alias("no_items"),
        F.count_if(F.col("basket_item_count") != F.col("line_count")).alias("mismatch"),
        F.coalesce(F.sum(F.when(F.col("order_id").isNull(), F.col("line_count"))), F.lit(0)).alias("no_order_lines"),
    )
    item_part = items.agg(
        F.count("*").alias("m"),
        F.count_if(F.col("order_id").isNull()).alias("i_no_order"),
        F.count_if(F.col("product_id").isNull()).alias("i_no_product"),
        F.count_if(F.col("quantity").isNull()).alias("no_quantity"),
        F.count_if(F.col("quantity") <= 0).alias("low_quantity"),
        F.count_if(F.col("unit_price").isNull()).alias("no_price"),
        F.count_if(F.col("unit_price") <= 0).alias("low_price"),
        F.count_if(F.col("line_net_amount").isNull()).alias("no_amount"),
        F.count_if(F.col("line_net_amount") <= 0).alias("low_amount"),
    )
    # the lines per pair serve the repeats and, summed per product, the orphans
    per_pair = items.groupBy("order_id", "product_id").agg(F.count("*").alias("lines"))
    whole = F.count_if(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
    orphans = _orphan_rows(per_pair, "product_id", products, "product_id", F.col("lines"), {"pairs": whole}).withColumnRenamed("orphans", "p_orphans")
    facts = order_part
    for one in (met, item_part, orphans):
        facts = facts.crossJoin(F.broadcast(one))  # one row each

    def key_part(df: DataFrame, key: str, p: str) -> DataFrame:
        return df.agg(
            F.count("*").alias(f"{p}_n"),
            F.count_if(F.col(key).isNull()).alias(f"{p}_null"),
            F.count(key).alias(f"{p}_keys"),
            (F.count(key) - F.countDistinct(key)).alias(f"{p}_repeats"),
        )

    dims = key_part(customers, "customer_id", "c").crossJoin(F.broadcast(key_part(products, "product_id", "p"))).crossJoin(
        F.broadcast(products.agg(F.count_if(F.col("unit_cost").isNull()).alias("no_cost")))
    )
    counts = _as_rows(facts, {
        1: ("no_order", "n"), 2: ("no_customer", "n"), 3: ("orphans", "n"), 4: ("no_date", "n"),
        5: ("future", "n"), 6: ("repeats", "n"), 7: ("no_items", "n"), 8: ("mismatch", "n"),
        9: ("bad_pct", "n"), 10: ("i_no_order", "m"), 11: ("i_no_product", "m"), 12: ("p_orphans", "m"),
        13: ("no_order_lines", "m"), 14: ("no_quantity", "m"), 15: ("low_quantity", "m"),
        16: ("no_price", "m"), 17: ("low_price", "m"), 18: ("no_amount", "m"), 19: ("low_amount", "m"),
        20: ("m - pairs", "m"), 26: ("n", "n"), 27: ("m", "m"),
    }).unionByName(_as_rows(dims, {
        21: ("c_null", "c_n"), 22: ("c_repeats", "c_keys"), 23: ("p_null", "p_n"),
        24: ("p_repeats", "p_keys"), 25: ("no_cost", "p_n"), 28: ("c_n", "c_n"), 29: ("p_n", "p_n"),
    }))
    literals = orders.sparkSession.createDataFrame(
        CLEAN_CHECKS,
        "check_order int, check_name string, source_column string, severity string, _done string",
    )
    share = F.when(
        F.col("table_rows") > 0, rounded_ratio(F.col("issue_count") * 100, F.col("table_rows"), 3)
    ).otherwise(F.lit(0).cast("decimal(28,3)"))
    return _audit_table(counts, literals, F.col("_done"), share)


def audit_findings(audit: DataFrame) -> DataFrame:
    """One sentence per check."""
    # Shortest form of the number: 6.7, not 6.700.
    share = F.regexp_replace(
        F.regexp_replace(F.col("pct_of_table").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", ""
    )
    name, n = F.col("check_name"), F.col("issue_count").cast("string")
    sentence = (
        F.when(F.col("issue_count").isNull(), F.concat(name, F.lit(" – Skipped. "), F.col("handling")))
        .when(F.col("severity") == "INFO", F.concat(name, F.lit(" – "), n, F.lit(" rows.")))
        .when(F.col("issue_count") == 0, F.concat(name, F.lit(" – No issues found.")))
        .otherwise(F.concat(
            F.lit("Found "), n, F.lit(" for "), name,
            F.coalesce(F.concat(F.lit(" ("), share, F.lit("%)")), F.lit("")),
            F.lit(" – "), F.col("handling"),
        ))
    )
    return audit.select("check_order", "severity", sentence.alias("finding")).orderBy("check_order")


# --- assertions -------------------------------------------------------------

def _countries(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("country")).filter("country IS NOT NULL").distinct()


def country_coverage(
    curated: DataFrame, segments: DataFrame, customers: DataFrame, fault: str = "none"
) -> DataFrame:
    """Three coverage checks with their violations; ``fault`` injects one defect."""
    if fault not in COVERAGE_FAULTS:
        raise ValueError("Negative test: unknown fault value")
    spark = curated.sparkSession
    foreign = spark.createDataFrame([(FOREIGN_COUNTRY,)], "country string")
    sold = _countries(curated, "country")
    scored = _countries(segments, "primary_country")
    known = _countries(customers, "country")
    if fault == "empty_curated":
        sold = sold.limit(0)
    elif fault == "extra_curated_country":
        sold = sold.union(foreign).distinct()
    elif fault == "segment_country_missing_from_dimension":
        scored = scored.union(foreign).distinct()
    one = (  # one row each
        sold.agg(F.when(F.count("*") == 0, 1).otherwise(0).alias("v1"))
        .crossJoin(F.broadcast(sold.subtract(scored).agg(F.count("*").alias("v2"))))
        .crossJoin(F.broadcast(scored.subtract(known).agg(F.count("*").alias("v3"))))
    )
    rows = ", ".join(f"{i}, '{m}', cast(v{i} as bigint)" for i, m in enumerate(COVERAGE_MESSAGES, 1))
    return one.selectExpr(f"stack(3, {rows}) as (check_order, message, violations)").withColumn(
        "passed", F.col("violations") == 0
    )


def assert_country_coverage(
    curated: DataFrame, segments: DataFrame, customers: DataFrame, fault: str = "none"
) -> None:
    """Stops the run at the first check that fails, with that check's message."""
    failed = country_coverage(curated, segments, customers, fault).filter("NOT passed").orderBy("check_order").first()
    if failed is not None:
        raise AssertionError(failed["message"])


def country_coverage_faults(curated: DataFrame, segments: DataFrame, customers: DataFrame) -> DataFrame:
    """The first check each injected fault trips; NULL for none."""
    per_fault = [
        country_coverage(curated, segments, customers, fault)
        .agg(F.min(F.when(~F.col("passed"), F.col("check_order"))).alias("first_failed_check"))
        .select(F.lit(fault).alias("fault"), "first_failed_check")
        for fault in COVERAGE_FAULTS
    ]
    return reduce(DataFrame.unionByName, per_fault)


def filled_columns(table: DataFrame) -> DataFrame:
    """Name, kind, place and number of filled rows of every column, from one scan."""
    kinds = {"string": "text", "date": "date"}
    counted = table.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(table.columns)])
    parts = ", ".join(f"'{c}', '{kinds.get(t, 'number')}', {i + 1}, c{i}" for i, (c, t) in enumerate(table.dtypes))
    return counted.selectExpr(f"stack({len(table.columns)}, {parts}) as (column_name, kind, ordinal_position, filled)")


def customer_dim_validation(enriched: DataFrame, customers: DataFrame) -> DataFrame:
    """Grain parity, uniqueness and scored customers of the enriched dimension."""
    counted = enriched.agg(
        F.count("*").alias("bi_dim_rows"),
        F.countDistinct("customer_id").alias("distinct_customers"),
        F.count_if(F.col("segment").isNull()).alias("null_segment_customers"),
        F.count_if(F.col("segment").isNotNull()).alias("scored_customers"),
    )
    std = customers.agg(F.count("*").alias("std_dim_rows"))
    return counted.crossJoin(F.broadcast(std)).select(
        "bi_dim_rows", "std_dim_rows",
        (F.col("bi_dim_rows") - F.col("std_dim_rows")).alias("row_delta"),
        "distinct_customers",
        (F.col("bi_dim_rows") - F.col("distinct_customers")).alias("dup_delta"),
        "null_segment_customers", "scored_customers",
    )
