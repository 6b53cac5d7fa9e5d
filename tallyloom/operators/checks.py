"""The audit checks, their sources, severities and handling notes."""

from __future__ import annotations

_ORDERS_SKIP = "Skipped because orders wildcard contract is broken"
_ITEMS_SKIP = "Skipped because items wildcard contract is broken"
_HEADER_SKIP = "Skipped because required header is missing"
_LOOKUP_SKIP = "Skipped because source or lookup contract is broken"

# (order, check, source column, severity, handling, handling when skipped)
RAW_CHECKS = (
    (1, "dim_customers missing required columns", "dim_customers schema", "CRITICAL", "Fix raw dimension headers before downstream standardisation", ""),
    (2, "dim_customers unexpected columns", "dim_customers schema", "LOW", "Review whether extra raw columns should be documented or standardised", ""),
    (3, "dim_products missing required columns", "dim_products schema", "CRITICAL", "Fix raw dimension headers before downstream joins", ""),
    (4, "dim_products unexpected columns", "dim_products schema", "LOW", "Review whether extra raw columns should be documented or standardised", ""),
    (5, "orders shards missing required columns", "orders20* schema", "CRITICAL", "Wildcard reads are unsafe until every shard exposes the required header set", ""),
    (6, "orders shards with physical type drift", "orders20* schema", "CRITICAL", "Reload shards with an enforced schema before using wildcard queries", ""),
    (7, "items shards missing required columns", "items20* schema", "CRITICAL", "Wildcard reads are unsafe until every shard exposes the required header set", ""),
    (8, "items shards with physical type drift", "items20* schema", "CRITICAL", "Reload shards with an enforced schema before using wildcard queries", ""),
    (9, "NULL customer lookup key", "dim_customers.CustomerID", "HIGH", "Fix raw dimension keys before referential checks and standardisation", _HEADER_SKIP),
    (10, "Duplicate customer lookup key", "dim_customers.CustomerID", "HIGH", "Dimension keys should be unique", _HEADER_SKIP),
    (11, "NULL product lookup key", "dim_products.ProductID", "HIGH", "Fix raw dimension keys before referential checks and joins", _HEADER_SKIP),
    (12, "Duplicate product lookup key", "dim_products.ProductID", "HIGH", "Dimension keys should be unique", _HEADER_SKIP),
    (13, "NULL OrderID", "orders.OrderID", "CRITICAL", "Excluded during cleaning because transaction key is missing", _ORDERS_SKIP),
    (14, "NULL CustomerID", "orders.CustomerID", "CRITICAL", "Excluded during cleaning because customer key is missing", _ORDERS_SKIP),
    (15, "Orphan CustomerID", "orders.CustomerID", "HIGH", "Investigate referential integrity between orders and dim_customers", _LOOKUP_SKIP),
    (16, "NULL OrderDate", "orders.OrderDate", "CRITICAL", "Excluded during cleaning because recency cannot be computed", _ORDERS_SKIP),
    (17, "Unparseable OrderDate", "orders.OrderDate", "CRITICAL", "SAFE_CAST to NULL during cleaning and exclude from validated orders", _ORDERS_SKIP),
    (18, "Future OrderDate", "orders.OrderDate", "MEDIUM", "Set to NULL during cleaning and exclude from validated orders", _ORDERS_SKIP),
    (19, "Whitespace in order keys", "orders.OrderID + CustomerID", "LOW", "Trim in cleaning intake", _ORDERS_SKIP),
    (20, "Negative LineNetAmount", "items.LineNetAmount", "CRITICAL", "Exclude during cleaning because negative revenue is treated as miscoded returns", _ITEMS_SKIP),
    (21, "Zero LineNetAmount", "items.LineNetAmount", "MEDIUM", "Exclude during cleaning as likely test or non-billable lines", _ITEMS_SKIP),
    (22, "NULL LineNetAmount", "items.LineNetAmount", "HIGH", "Exclude during cleaning because amount is unknown", _ITEMS_SKIP),
    (23, "Unparseable LineNetAmount", "items.LineNetAmount", "HIGH", "SAFE_CAST to NULL during cleaning and exclude from validated items", _ITEMS_SKIP),
    (24, "Cents format suspicion", "items.LineNetAmount", "HIGH", "Normalise by dividing by 100 during cleaning when this pattern is detected", _ITEMS_SKIP),
    (25, "Orphan ProductID", "items.ProductID", "HIGH", "Investigate referential integrity between items and dim_products", _LOOKUP_SKIP),
    (26, "Whitespace in item keys", "items.OrderID + ProductID", "LOW", "Trim in cleaning intake", _ITEMS_SKIP),
    (27, "Duplicate line items", "items.OrderID + ProductID + source_month", "HIGH", "Deduplicate during cleaning, keeping the latest shard occurrence", _ITEMS_SKIP),
    (28, "dim_customers row count", "dim_customers", "INFO", "Reference row count for the raw lookup table", ""),
    (29, "dim_products row count", "dim_products", "INFO", "Reference row count for the raw lookup table", ""),
)

_ZERO = "Should be zero after cleaning"
_ZERO_DIM = "Should be zero after cleaning and dimension standardisation"
_COUNT = "Reference row count"

# (order, check, source column, severity, handling)
CLEAN_CHECKS = (
    (1, "NULL order_id", "stg_orders_validated.order_id", "CRITICAL", _ZERO),
    (2, "NULL customer_id", "stg_orders_validated.customer_id", "CRITICAL", _ZERO),
    (3, "Orphan customer_id", "stg_orders_validated.customer_id", "HIGH", _ZERO_DIM),
    (4, "NULL order_date", "stg_orders_validated.order_date", "CRITICAL", _ZERO),
    (5, "Future order_date", "stg_orders_validated.order_date", "HIGH", _ZERO),
    (6, "Duplicate order_id", "stg_orders_validated.order_id", "HIGH", "Should be zero after order de-duplication"),
    (7, "Orders with no validated items", "stg_orders_validated -> stg_items_validated", "HIGH", "Orders dropped from sales_curated by INNER JOIN to validated items in Step 02"),
    (8, "Basket count mismatch vs validated items", "stg_orders_validated.basket_item_count", "MEDIUM", "Review whether basket_item_count should represent distinct products or raw line count"),
    (9, "Discount pct out of range", "stg_orders_validated.order_discount_pct", "MEDIUM", _ZERO),
    (10, "NULL order_id", "stg_items_validated.order_id", "CRITICAL", _ZERO),
    (11, "NULL product_id", "stg_items_validated.product_id", "CRITICAL", _ZERO),
    (12, "Orphan product_id", "stg_items_validated.product_id", "HIGH", _ZERO_DIM),
    (13, "Items without validated order", "stg_items_validated -> stg_orders_validated", "HIGH", "These rows will not join into sales_curated"),
    (14, "NULL quantity", "stg_items_validated.quantity", "CRITICAL", _ZERO),
    (15, "Non-positive quantity", "stg_items_validated.quantity", "HIGH", _ZERO),
    (16, "NULL unit_price", "stg_items_validated.unit_price", "CRITICAL", _ZERO),
    (17, "Non-positive unit_price", "stg_items_validated.unit_price", "HIGH", _ZERO),
    (18, "NULL line_net_amount", "stg_items_validated.line_net_amount", "CRITICAL", _ZERO),
    (19, "Non-positive line_net_amount", "stg_items_validated.line_net_amount", "HIGH", _ZERO),
    (20, "Duplicate line items", "stg_items_validated.order_id + product_id", "HIGH", "Should be zero after item de-duplication"),
    (21, "NULL customer standard key", "v_dim_customers_std.customer_id", "HIGH", "Standardised customer keys should be present"),
    (22, "Duplicate customer standard key", "v_dim_customers_std.customer_id", "HIGH", "Standardised customer keys should be unique"),
    (23, "NULL product standard key", "v_dim_products_std.product_id", "HIGH", "Standardised product keys should be present"),
    (24, "Duplicate product standard key", "v_dim_products_std.product_id", "HIGH", "Standardised product keys should be unique"),
    (25, "NULL unit_cost in product lookup", "v_dim_products_std.unit_cost", "HIGH", "Unit cost is required for profit calculations in Step 02"),
    (26, "stg_orders_validated row count", "stg_orders_validated", "INFO", _COUNT),
    (27, "stg_items_validated row count", "stg_items_validated", "INFO", _COUNT),
    (28, "v_dim_customers_std row count", "v_dim_customers_std", "INFO", _COUNT),
    (29, "v_dim_products_std row count", "v_dim_products_std", "INFO", _COUNT),
)

# Country coverage: the message of each failing check.
COVERAGE_MESSAGES = (
    "Country coverage: sales_curated holds no country",
    "Country coverage: a country on a curated order is missing from rfm_customer_segments",
    "Country coverage: rfm_customer_segments holds a country missing from the customer dimension",
)
COVERAGE_FAULTS = (
    "none",
    "empty_curated",
    "extra_curated_country",
    "segment_country_missing_from_dimension",
)
FOREIGN_COUNTRY = "Atlantis"
