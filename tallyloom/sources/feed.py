"""The driver's tables as a raw shop export: all-text rows, one month per shard.

The tables are clean, so the export also carries the defects the cleaning stage
exists for. Which rows carry which defect follows from the row's own price, so
the defects are the same on every run and grow with the tables. Every column
comes from the row itself: the export needs no join or shuffle.

Stand-ins for columns the tables lack: declared basket size = the digit of the
order priority; order discount = whole part of the total price modulo 56, in
percent; unit price = extended price / quantity; unit cost = 60 % of the retail
price; country / state / city = region / nation / market segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.staging import fingerprint

# The shards with defects of shape, (month, column) by kind.
FAULTS = {
    "orders": {"dropped": ("199703", "OrderDiscountPct"), "retyped": ("199605", "OrderDate")},
    "items": {"dropped": ("199808", "UnitPrice"), "retyped": ("199702", "Quantity")},
}


def faulty(raw: DataFrame, kind: str) -> list[DataFrame]:
    """raw in parts of one shape each: the sound months, one without a column, one with a column of another type.

    Dates lose their dashes, which makes whole numbers of them; quantities get a unit, which makes text of them.
    """
    (gone, lost), (other, column) = FAULTS[kind]["dropped"], FAULTS[kind]["retyped"]
    text = F.replace(F.col(column), F.lit("-"), F.lit("")) if column == "OrderDate" else F.concat(F.col(column), F.lit(" pc"))
    return [
        raw.filter(~F.col("source_month").isin(gone, other)),
        raw.filter(F.col("source_month") == gone).drop(lost),
        raw.filter(F.col("source_month") == other).withColumn(column, text),
    ]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fact_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Size of the files of orders and lines, from the listing."""
    facts = ("/orders.parquet", "/lineitem.parquet")
    return sum(size for path, size, _ in fingerprint(spark, sf_dir) if any(name in path for name in facts))


def _by_band(price: Column, usual: Column, bands: Sequence[tuple[int, int, Column]]) -> Column:
    """usual, replaced where price lies in [low, high)."""
    out = None
    for low, high, text in bands:
        hit = (price >= low) & (price < high)
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return usual if out is None else out.otherwise(usual)


def _hundredths(c: Column) -> Column:
    """A two-digit double as a whole number of hundredths. Whole-number arithmetic
    is exact here and far cheaper than decimals built from doubles."""
    return F.rint(c * 100).cast("bigint")


def _money_text(cents: Column) -> Column:
    whole, rest = F.floor(cents / 100).cast("bigint"), (cents % 100).cast("string")
    return F.concat(whole.cast("string"), F.lit("."), F.lpad(rest, 2, "0"))


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    key, customer = _text("o_orderkey"), _text("o_custkey")
    day = F.col("o_orderdate")
    pct = (F.floor(price) % 56).cast("decimal(4,0)")
    discount = (pct / 100).cast("decimal(4,2)").cast("string")
    basket = F.substring("o_orderpriority", 1, 1)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    return orders.select(
        _by_band(price, key, [
            (0, 3000, F.lit("")),
            (3000, 4000, F.lit("   ")),
            (4000, 6000, F.lit(None).cast("string")),
            (25000, 30000, F.concat(F.lit("  "), key, F.lit("\t"))),
        ]).alias("OrderID"),
        _by_band(price, customer, [
            (6000, 9000, F.lit(None).cast("string")),
            (9000, 10000, F.lit(" ")),
            (30000, 35000, F.concat(customer, F.lit(" "))),
        ]).alias("CustomerID"),
        _by_band(price, F.date_format(day, "yyyy-MM-dd"), [
            (10000, 13000, F.date_format(day, "dd.MM.yyyy")),
            (13000, 15000, F.date_format(day, "yyyy")),
            (15000, 18000, F.lit("2027-01-01")),
            (18000, 20000, F.lit("1970-01-01")),
            (20000, 22000, F.lit("")),
            (22000, 24000, F.lit(None).cast("string")),
            (24000, 25000, F.date_format(day, "yyyy-M-d")),
        ]).alias("OrderDate"),
        _by_band(price, discount, [
            (35000, 38000, F.lit("1.5")),
            (38000, 41000, F.lit("abc")),
            (41000, 44000, F.lit(" ")),
            (44000, 47000, F.lit(None).cast("string")),
        ]).alias("OrderDiscountPct"),
        _by_band(price, basket, [
            (50000, 55000, F.lit("0")),
            (55000, 60000, F.lit("two")),
            (60000, 65000, F.lit("")),
        ]).alias("BasketItemCount"),
        F.date_format(day, "yyyyMM").alias("source_month"),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    order, product = _text("l_orderkey"), _text("l_partkey")
    quantity = F.col("l_quantity").cast("bigint")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"
    )
    # Halves round up: add half the divisor before the whole-number division.
    gross = _hundredths(price)
    kept = 100 - _hundredths(F.col("l_discount"))
    lines = lines.withColumns({
        "net": F.floor((gross * kept + 50) / 100).cast("bigint"),
        "unit": F.floor((2 * gross + quantity) / (2 * quantity)).cast("bigint"),
    })
    net, unit = F.col("net"), F.col("unit")
    return lines.select(
        _by_band(price, order, [
            (10000, 11000, F.concat(F.lit(" "), order)),
            (12000, 12500, F.lit(None).cast("string")),
            (12500, 13000, F.lit("")),
        ]).alias("OrderID"),
        _text("l_linenumber").alias("LineNumber"),
        _by_band(price, product, [
            (9000, 10000, F.concat(product, F.lit("\t "))),
            (11000, 11500, F.lit("  ")),
            (11500, 12000, F.lit(None).cast("string")),
            (13000, 14000, F.concat(F.lit("X"), product)),
        ]).alias("ProductID"),
        _by_band(price, quantity.cast("string"), [
            (6000, 6500, F.lit("0")),
            (6500, 7000, F.lit("-1")),
            (7000, 7500, F.concat(quantity.cast("string"), F.lit(".0"))),
            (7500, 7800, F.lit("")),
            (7800, 8000, F.lit(None).cast("string")),
        ]).alias("Quantity"),
        _by_band(price, _money_text(unit), [
            (8000, 8400, F.lit("-1.50")),
            (8400, 8600, F.lit("n/a")),
            (8600, 8800, F.lit("")),
            (8800, 9000, F.lit(None).cast("string")),
        ]).alias("UnitPrice"),
        _by_band(price, _money_text(net), [
            (1000, 2000, F.concat(F.lit("-"), _money_text(net))),
            (2000, 3000, F.lit("0")),
            (3000, 4000, F.lit("")),
            (4000, 5000, F.lit(None).cast("string")),
            (5000, 6000, F.lit("12,50")),
            (20000, 25000, net.cast("string")),
            (14000, 14500, net.cast("string")),
        ]).alias("LineNetAmount"),
        F.date_format("l_shipdate", "yyyyMM").alias("source_month"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    key = _text("c_custkey")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            _by_band(balance, key, [
                (-1000, -960, F.lit(None).cast("string")),
                (-960, -920, F.lit(" ")),
                (-920, -800, F.concat(F.lit(" "), key)),
            ]).alias("CustomerID"),
            F.date_format(F.date_add(F.lit("1994-01-01").cast("date"), F.abs(balance).cast("int") % 365), "yyyy-MM-dd").alias("SignupDate"),
            F.col("c_mktsegment").alias("CustomerArchetype"),
            F.split("c_name", "#")[0].alias("FirstName"),
            _by_band(balance, F.concat(F.split("c_name", "#")[1], F.lit(" ")), [
                (0, 200, F.lit(" ")),
            ]).alias("LastName"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.org")).alias("Email"),
            _by_band(balance, F.concat(F.lit("+00 "), key), [(-1000, 0, F.lit(""))]).alias("Phone"),
            _by_band(balance, F.concat(F.lit(" "), F.col("r_name")), [(0, 50, F.lit(""))]).alias("Country"),
            F.col("n_name").alias("State"),
            F.col("c_mktsegment").alias("City"),
            F.concat(F.col("n_name"), F.lit(", "), key).alias("Address"),
        )
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    retail = F.col("p_retailprice").cast("decimal(12,2)")
    cost = F.round(retail * F.lit("0.6").cast("decimal(2,1)"), 2).cast("decimal(12,2)")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), _text("p_partkey")).alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("ProductCategory"),
        F.col("p_brand").alias("Brand"),
        retail.cast("string").alias("RetailPrice"),
        cost.cast("string").alias("UnitCost"),
        F.lit("0.4").alias("MarginPct"),
    )
