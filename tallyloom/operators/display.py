"""Display names of the consumption layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Names that are not the title-cased column name.
DISPLAY_NAMES = {
    "customer_id": "Customer ID",
    "order_id": "Order ID",
    "product_id": "Product ID",
    "line_margin_pct": "Line Margin %",
    "margin_pct": "Margin %",
    "order_margin_pct": "Order Margin %",
    "rfm_cell": "RFM Cell",
    "r_score": "R Score",
    "f_score": "F Score",
    "m_score": "M Score",
}


def display_name(column: str) -> str:
    return DISPLAY_NAMES.get(column, column.replace("_", " ").title())


def with_display_names(df: DataFrame) -> DataFrame:
    """Same rows, columns renamed for readers."""
    return df.withColumnsRenamed({c: display_name(c) for c in df.columns})
