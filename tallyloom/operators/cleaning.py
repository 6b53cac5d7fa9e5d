"""Raw monthly rows -> typed intake -> cleaned with flags -> validated.

Orders and items are two independent inputs with the same four steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.config import RetailConfig
from tallyloom.functions.numeric import MONEY, rounded, ratio
from tallyloom.functions.rows import settled
from tallyloom.functions.text import iso_date, trimmed

ORDER_COLUMNS = ("OrderID", "CustomerID", "OrderDate", "OrderDiscountPct", "BasketItemCount")
ITEM_COLUMNS = ("OrderID", "LineNumber", "ProductID", "Quantity", "UnitPrice", "LineNetAmount")


def in_window(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Only the month shards of the run; prunes partitions of a sharded source."""
    return raw.filter(F.col("source_month").between(cfg.start_month, cfg.end_month))


def _content_key(columns: tuple[str, ...]) -> Column:
    """MD5 of the whole raw row with its month: equal for byte-identical rows only."""
    return F.md5(F.to_json(F.struct("source_month", *columns), {"ignoreNullFields": "false"}))


def _with_text(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Adds t_<column>, the trimmed text, in a projection of its own.

    Later columns use it several times; as a column it is computed once.
    """
    return df.withColumns({f"t_{c}": trimmed(F.col(c).cast("string")) for c in columns})


def _typed_orders(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    return _with_text(in_window(raw, cfg), ORDER_COLUMNS).select(
        "*",
        _content_key(ORDER_COLUMNS).alias("row_id"),
        F.nullif("t_OrderID", F.lit("")).alias("order_id"),
        F.nullif("t_CustomerID", F.lit("")).alias("customer_id"),
        iso_date(F.col("t_OrderDate")).alias("day"),
        F.col("t_OrderDiscountPct").try_cast("decimal(38,9)").alias("pct"),
        F.col("t_BasketItemCount").try_cast("bigint").alias("basket"),
    )


def _typed_items(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    return _with_text(in_window(raw, cfg), ITEM_COLUMNS).select(
        "*",
        _content_key(ITEM_COLUMNS).alias("row_id"),
        F.nullif("t_OrderID", F.lit("")).alias("order_id"),
        F.nullif("t_ProductID", F.lit("")).alias("product_id"),
        F.col("t_Quantity").try_cast("bigint").alias("quantity_raw"),
        F.col("t_UnitPrice").try_cast("decimal(38,9)").alias("price_raw"),
        F.col("t_LineNetAmount").try_cast("decimal(38,9)").alias("amount_raw"),
    )


_RAW_ORDER_NAMES = {
    "OrderID": "raw_order_id", "CustomerID": "raw_customer_id", "OrderDate": "raw_order_date",
    "OrderDiscountPct": "raw_order_discount_pct", "BasketItemCount": "raw_basket_item_count",
}
_RAW_ITEM_NAMES = {
    "OrderID": "raw_order_id", "ProductID": "raw_product_id", "Quantity": "raw_quantity",
    "UnitPrice": "raw_unit_price", "LineNetAmount": "raw_line_amount",
}


def _renamed(names: dict[str, str]) -> list[Column]:
    return [F.col(c).cast("string").alias(name) for c, name in names.items()]


def orders_intake(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    return _typed_orders(raw, cfg).select(
        "row_id", *_renamed(_RAW_ORDER_NAMES), "order_id", "customer_id",
        F.col("day").alias("order_date"),
        F.col("pct").alias("order_discount_pct_raw"),
        F.col("basket").alias("basket_item_count_raw"),
        "source_month",
    )


def items_intake(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    return _typed_items(raw, cfg).select(
        "row_id", *_renamed(_RAW_ITEM_NAMES), "order_id", "product_id", "quantity_raw",
        F.col("price_raw").alias("unit_price_raw"),
        F.col("amount_raw").alias("line_net_amount_raw"),
        "source_month",
    )


def _null(raw: str) -> Column:
    return F.col(raw).isNull()


def _blank(raw: str) -> Column:
    return F.col(f"t_{raw}") == ""


def _unparseable(raw: str, parsed: str) -> Column:
    return (F.col(f"t_{raw}") != "") & F.col(parsed).isNull()


def _padded(*raw: str) -> Column:
    """Any key differs from its trimmed form (NULL when undecidable)."""
    tests = [F.col(c) != F.col(f"t_{c}") for c in raw]
    return tests[0] | tests[1]


def cents_line(cfg: RetailConfig, amount: Column, quantity: Column, price: Column) -> Column:
    low, high = cfg.cents_band
    by_size = (amount > F.lit(cfg.cents_guard)) & (
        amount.between(F.lit(low * 100), F.lit(high * 100))
    )
    # Operands narrow enough for an exact product; an absurd operand decides nothing.
    multiple = F.try_multiply(quantity, F.lit(cfg.cents_list_multiple).cast("bigint"))
    by_list = (quantity > 0) & (price > 0) & (
        amount >= multiple.try_cast("decimal(18,0)") * price.try_cast("decimal(19,9)")
    )
    return by_size | by_list


def _flags(rules: list[tuple[str, Column]]) -> Column:
    """Names of the rules that hold, joined by a bar; '' for a clean row."""
    return F.concat_ws("|", *[F.when(test, F.lit(name)) for name, test in rules])


def order_flag_rules(cfg: RetailConfig) -> list[tuple[str, Column]]:
    day, pct, basket = F.col("day"), F.col("pct"), F.col("basket")
    return [
        ("BLANK_ORDER_ID", _blank("OrderID")),
        ("BLANK_CUSTOMER_ID", _blank("CustomerID")),
        ("BLANK_DATE", _blank("OrderDate")),
        ("TRIMMED_KEYS", _padded("OrderID", "CustomerID")),
        ("NULL_ORDER_ID", _null("OrderID")),
        ("NULL_CUSTOMER_ID", _null("CustomerID")),
        ("NULL_DATE", _null("OrderDate")),
        ("UNPARSEABLE_DATE", _unparseable("OrderDate", "day")),
        ("FUTURE_DATE", day > F.lit(cfg.as_of_date)),
        ("TOO_EARLY_DATE", day < F.lit(cfg.min_order_date)),
        ("BLANK_DISCOUNT_PCT", _blank("OrderDiscountPct")),
        ("UNPARSEABLE_DISCOUNT_PCT", _unparseable("OrderDiscountPct", "pct")),
        ("DISCOUNT_PCT_OUT_OF_RANGE", ~pct.between(0, 1)),
        ("BLANK_BASKET_COUNT", _blank("BasketItemCount")),
        ("UNPARSEABLE_BASKET_COUNT", _unparseable("BasketItemCount", "basket")),
        ("NON_POSITIVE_BASKET_COUNT", basket <= 0),
    ]


def item_flag_rules() -> list[tuple[str, Column]]:
    quantity, price, amount = F.col("quantity_raw"), F.col("price_raw"), F.col("amount_raw")
    return [
        ("BLANK_ORDER_ID", _blank("OrderID")),
        ("BLANK_PRODUCT_ID", _blank("ProductID")),
        ("TRIMMED_KEYS", _padded("OrderID", "ProductID")),
        ("NULL_ORDER_ID", _null("OrderID")),
        ("NULL_PRODUCT_ID", _null("ProductID")),
        ("NULL_QUANTITY", _null("Quantity")),
        ("BLANK_QUANTITY", _blank("Quantity")),
        ("UNPARSEABLE_QUANTITY", _unparseable("Quantity", "quantity_raw")),
        ("NON_POSITIVE_QUANTITY", quantity <= 0),
        ("NULL_UNIT_PRICE", _null("UnitPrice")),
        ("BLANK_UNIT_PRICE", _blank("UnitPrice")),
        ("UNPARSEABLE_UNIT_PRICE", _unparseable("UnitPrice", "price_raw")),
        ("NON_POSITIVE_UNIT_PRICE", price <= 0),
        ("NULL_AMOUNT", _null("LineNetAmount")),
        ("BLANK_AMOUNT", _blank("LineNetAmount")),
        ("UNPARSEABLE_AMOUNT", _unparseable("LineNetAmount", "amount_raw")),
        ("NEGATIVE_AMOUNT", amount < 0),
        ("ZERO_AMOUNT", amount == 0),
        ("CENTS_CONVERTED", F.col("in_cents")),
    ]


def orders_cleaned(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    day, pct, basket = F.col("day"), F.col("pct"), F.col("basket")
    in_range = day.between(F.lit(cfg.min_order_date), F.lit(cfg.as_of_date))
    return _typed_orders(raw, cfg).select(
        "row_id", "source_month", *_renamed(_RAW_ORDER_NAMES), "order_id", "customer_id",
        F.when(in_range, day).alias("order_date"),
        F.when(pct.between(0, 1), pct.try_cast("decimal(10,9)")).alias("order_discount_pct"),
        F.when(basket > 0, basket).alias("basket_item_count"),
        _flags(order_flag_rules(cfg)).alias("cleaning_flags"),
    )


def items_cleaned(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    quantity, price, amount = F.col("quantity_raw"), F.col("price_raw"), F.col("amount_raw")
    typed = _typed_items(raw, cfg).withColumn("in_cents", cents_line(cfg, amount, quantity, price))
    in_euro = F.when(F.col("in_cents"), amount / 100).otherwise(amount)
    return typed.select(
        "row_id", "source_month", *_renamed(_RAW_ITEM_NAMES), "order_id", "product_id",
        F.when(quantity > 0, quantity).alias("quantity"),
        F.when(price > 0, F.round(price, 2).cast(MONEY)).alias("unit_price"),
        F.when(amount > 0, F.round(in_euro, 2).cast(MONEY)).alias("line_net_amount"),
        _flags(item_flag_rules()).alias("cleaning_flags"),
    )


def _newest(cleaned: DataFrame, keys: list[str], parts: int | None) -> DataFrame:
    """One row per key: newest month first, then the content key.

    Without ``parts``, row_number() <= 1 also runs before the shuffle, per input task, so a
    key with very many copies reaches the shuffle as one row per task. With it, rows are dealt
    by order id into that many partitions first, so that a task sorts its share only, however
    large the input's files are, and the result lies there by order id.
    """
    # sorts as its text does, in half the bytes
    rows = cleaned.withColumn("row_id", F.unhex("row_id"))
    if parts is not None:
        rows = rows.repartition(parts, "order_id")
    order = Window.partitionBy(*keys).orderBy(F.desc("source_month"), F.asc("row_id"))
    return rows.withColumn("_pick", F.row_number().over(order)).filter("_pick = 1")


def orders_validated(cleaned: DataFrame, parts: int | None = None) -> DataFrame:
    columns = ["order_id", "customer_id", "order_date", "order_discount_pct", "basket_item_count", "source_month", "cleaning_flags"]
    complete = settled(cleaned.select("row_id", *columns)).dropna(subset=["order_id", "customer_id", "order_date"])
    return _newest(complete, ["order_id"], parts).select(*columns)


def items_validated(cleaned: DataFrame, parts: int | None = None) -> DataFrame:
    columns = ["order_id", "product_id", "quantity", "unit_price", "line_net_amount", "source_month", "cleaning_flags"]
    complete = settled(cleaned.select("row_id", *columns)).dropna(
        subset=["order_id", "product_id", "quantity", "unit_price", "line_net_amount"]
    )
    return _newest(complete, ["order_id", "product_id"], parts).select(*columns)


def flag_counts(cleaned: DataFrame, stream: str) -> DataFrame:
    flagged = cleaned.filter("cleaning_flags <> ''")
    return (
        flagged.select(F.explode(F.split("cleaning_flags", r"\|")).alias("flag"))
        .groupBy("flag").agg(F.count("*").alias("cnt"))
        .withColumn("stream_type", F.lit(stream))
    )


def stage_row_counts(
    orders_in: DataFrame, orders_ok: DataFrame, items_in: DataFrame, items_ok: DataFrame
) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("rows_count")).select(F.lit(name).alias("stage_name"), "rows_count")
        for name, df in (
            ("Orders intake", orders_in), ("Orders validated", orders_ok),
            ("Items intake", items_in), ("Items validated", items_ok),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def cleaning_log(
    orders_clean: DataFrame, orders_ok: DataFrame, items_clean: DataFrame, items_ok: DataFrame
) -> DataFrame:
    """An overview line, then one line per input and flag in name order."""
    counts = (
        stage_row_counts(orders_clean, orders_ok, items_clean, items_ok)
        .groupBy().pivot("stage_name", ["Orders intake", "Orders validated", "Items intake", "Items validated"])
        .agg(F.first("rows_count"))
    )

    def line(kind: str) -> Column:
        before, after = F.col(f"{kind} intake"), F.col(f"{kind} validated")
        # Shortest form of the number: 98.5, not 98.50.
        pct = rounded(ratio(after, before) * 100, 2).cast("string")
        short = F.regexp_replace(F.regexp_replace(pct, r"0+$", ""), r"\.$", "")
        return F.concat(
            F.lit(f"{kind}: "), before.cast("string"), F.lit(" intake -> "), after.cast("string"),
            F.lit(" validated ("), short, F.lit("% retention)."),
        )

    overview = counts.select(
        F.lit(0).cast("bigint").alias("entry_order"),
        F.lit("PIPELINE OVERVIEW").alias("rule_name"),
        F.concat(line("Orders"), F.lit(" "), line("Items")).alias("finding"),
    )
    flags = flag_counts(orders_clean, "orders").unionByName(flag_counts(items_clean, "items"))
    # At most one row per rule (35 in all), so one sorting task is enough.
    listed = flags.select(
        F.row_number().over(Window.orderBy("stream_type", "flag")).cast("bigint").alias("entry_order"),
        F.concat("stream_type", F.lit(": "), "flag").alias("rule_name"),
        F.concat(F.col("cnt").cast("string"), F.lit(" rows flagged in "), "stream_type", F.lit(" stream.")).alias("finding"),
    )
    return overview.unionByName(listed)
