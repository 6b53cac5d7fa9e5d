"""Standardised customer and product tables, and the enriched customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import clean_text, parse_date, parse_number

CUSTOMER_COLUMNS = (
    "CustomerID", "SignupDate", "CustomerArchetype", "FirstName", "LastName", "Email",
    "Phone", "Country", "State", "City", "Address",
)
PRODUCT_COLUMNS = (
    "ProductID", "ProductName", "ProductCategory", "Brand", "RetailPrice", "UnitCost", "MarginPct",
)
_RATE = "decimal(18,4)"


def _text(name: str):
    return clean_text(F.col(name).cast("string"))


def standardize_customers(raw: DataFrame) -> DataFrame:
    first, last = _text("FirstName"), _text("LastName")
    return raw.select(
        _text("CustomerID").alias("customer_id"),
        parse_date(F.col("SignupDate").cast("string")).alias("signup_date"),
        _text("CustomerArchetype").alias("customer_archetype"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat_ws(" ", first, last).alias("full_name"),
        *[_text(n).alias(n.lower()) for n in ("Email", "Phone", "Country", "State", "City", "Address")],
    )


def standardize_products(raw: DataFrame) -> DataFrame:
    def number(name: str):
        return parse_number(F.col(name).cast("string")).cast(_RATE)

    return raw.select(
        _text("ProductID").alias("product_id"),
        _text("ProductName").alias("product_name"),
        _text("ProductCategory").alias("product_category"),
        _text("Brand").alias("brand"),
        number("RetailPrice").alias("retail_price"),
        number("UnitCost").alias("unit_cost"),
        number("MarginPct").alias("margin_pct"),
    )


def dim_customers_for_bi(customers: DataFrame, rfm: DataFrame) -> DataFrame:
    """Customer master plus RFM columns; customers without orders keep NULLs.

    The master's own geography wins over the one taken from the latest order.
    """
    return customers.join(rfm.drop("country", "state", "city"), "customer_id", "left")
