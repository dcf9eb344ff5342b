"""Target types of the raw source columns the pipeline uses; all others stay text.

Raw CSV files are read as strings (no inference, no positional binding); each needed column
is found by its header name and ``try_cast`` to the type below, so a missing column fails
at once and an unparsable cell becomes NULL (counted by the data-quality operator).
"""

from __future__ import annotations

# Raw file names of the public marketplace dataset and the columns used.
RAW_FILES = {
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}

# Roles whose quoted text holds line breaks.
MULTILINE_ROLES = ("reviews",)

# Money keeps ten decimals: sums stay exact and no published amount is rounded.
ROLE_COLUMNS: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "price": "decimal(26,10)",
        "freight_value": "decimal(26,10)",
    },
    "payments": {
        "order_id": "string",
        "payment_sequential": "int",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": "decimal(26,10)",
    },
    "reviews": {
        "order_id": "string",
        "review_score": "int",
    },
    "customers": {
        "customer_id": "string",
        "customer_state": "string",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_weight_g": "int",
        "product_length_cm": "int",
        "product_height_cm": "int",
        "product_width_cm": "int",
    },
    "sellers": {
        "seller_id": "string",
        "seller_state": "string",
        "seller_city": "string",
    },
    "category_translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
}
