"""Explicit schemas of the raw tables; nothing is inferred at read time."""

from __future__ import annotations

RAW_SCHEMAS: dict[str, str] = {
    "orders": (
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz"
    ),
    "order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price decimal(12,2), freight_value decimal(12,2)"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_length int, "
        "product_description_length int, product_photos_qty int, product_weight_g double, "
        "product_length_cm double, product_height_cm double, product_width_cm double"
    ),
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "payments": (
        "order_id string, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value decimal(12,2)"
    ),
    "reviews": (
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp_ntz, "
        "review_answer_timestamp timestamp_ntz"
    ),
    "geolocation": (
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string"
    ),
    "sellers": (
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
    ),
    "category_translation": (
        "product_category_name string, product_category_name_english string"
    ),
}

PANEL_SCHEMA = (
    "date date, category string, order_count bigint, avg_price double, total_revenue double, "
    "avg_freight double, avg_review_score double, avg_installments double"
)
METRICS_SCHEMA = "category string, mape double, rmse double, mae double"
