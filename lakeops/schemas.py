"""Table schemas of the star schema, the match-event layers, the order
stream and the ticket log, plus the constraint lists the quality audit
checks (PRIMARY KEY / UNIQUE / NOT NULL / FOREIGN KEY / VARCHAR(n))."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
D, TS, TSNTZ = T.DateType(), T.TimestampType(), T.TimestampNTZType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# --- star schema -----------------------------------------------------------
DIM_CUSTOMERS = T.StructType([
    _f("customer_id", I, False), _f("customer_name", S, False), _f("email", S),
    _f("phone", S), _f("country", S), _f("created_at", TSNTZ)])

DIM_PRODUCTS = T.StructType([
    _f("product_id", I, False), _f("product_name", S, False), _f("category", S),
    _f("unit_price", T.DecimalType(10, 2), False), _f("created_at", TSNTZ)])

DIM_ORDERS = T.StructType([
    _f("order_id", I, False), _f("customer_id", I, False), _f("payment_method", S),
    _f("order_date", D, False), _f("total_sales", T.DecimalType(12, 2))])

FACT_ORDER_ITEMS = T.StructType([
    _f("order_item_id", L, False), _f("order_id", I, False), _f("product_id", I, False),
    _f("quantity", I, False), _f("unit_price_paid", T.DecimalType(10, 2), False),
    _f("line_item_sales", T.DecimalType(12, 2), False), _f("created_at", TSNTZ)])

FACT_SHIPMENTS = T.StructType([
    _f("shipment_id", L, False), _f("order_item_id", L, False),
    _f("shipping_cost", T.DecimalType(10, 2)), _f("pickup_date", D),
    _f("delivery_date", D), _f("on_time_delivery", B), _f("damage_reported", B),
    _f("created_at", TSNTZ)])

STAR = {
    "dim_customers": DIM_CUSTOMERS,
    "dim_products": DIM_PRODUCTS,
    "dim_orders": DIM_ORDERS,
    "fact_order_items": FACT_ORDER_ITEMS,
    "fact_shipments": FACT_SHIPMENTS,
}

# --- match events (medallion) ---------------------------------------------
EVENT_SOURCE = T.StructType([
    _f("event_id", S), _f("match_id", S), _f("team", S), _f("player", S),
    _f("event_type", S), _f("event_ts", TSNTZ)])

BRONZE = T.StructType([
    _f("event_id", S), _f("match_id", S), _f("team", S), _f("player", S),
    _f("event_type", S), _f("timestamp", TSNTZ)])

SILVER = T.StructType([
    _f("match_id", S), _f("team", S), _f("event_type", S), _f("timestamp", TSNTZ)])

# --- order stream ---------------------------------------------------------
# the quantity keeps its JSON type, so one parse tells 7 from "7"
ORDER_MESSAGE = T.StructType([
    _f("order_id", S), _f("user", S), _f("item", S), _f("quantity", T.VariantType())])

ORDERS_TARGET = T.StructType([
    _f("order_uuid", S, False), _f("username", S), _f("item_name", S),
    _f("quantity", I), _f("created_at", TSNTZ)])

# --- ticket log -----------------------------------------------------------
LOG_RECORD = T.StructType([
    _f("op", S), _f("ticket_id", S), _f("passenger_name", S),
    _f("created_at", S), _f("expires_at", S)])

# --- constraints (declared in the star-schema and target DDL) -------------
# The declared constraints of the source DDL.
NOT_NULL = {
    "dim_customers": ["customer_id", "customer_name"],
    "dim_products": ["product_id", "product_name", "unit_price"],
    "dim_orders": ["order_id", "customer_id", "order_date"],
    "fact_order_items": ["order_item_id", "order_id", "product_id", "quantity",
                         "unit_price_paid", "line_item_sales"],
    "fact_shipments": ["shipment_id", "order_item_id"],
    "orders": ["order_uuid"],
}
UNIQUE = {
    "dim_customers": [["customer_id"], ["email"]],
    "dim_products": [["product_id"]],
    "dim_orders": [["order_id"]],
    "fact_order_items": [["order_item_id"]],
    "fact_shipments": [["shipment_id"]],
    "orders": [["order_uuid"]],
}
# child table, child columns, parent table, parent columns
FOREIGN_KEYS = [
    ("dim_orders", ["customer_id"], "dim_customers", ["customer_id"]),
    ("fact_order_items", ["order_id"], "dim_orders", ["order_id"]),
    ("fact_order_items", ["product_id"], "dim_products", ["product_id"]),
    ("fact_shipments", ["order_item_id"], "fact_order_items", ["order_item_id"]),
]
MAX_LENGTH = {
    "dim_customers": {"customer_name": 50, "email": 50, "phone": 50, "country": 20},
    "dim_products": {"product_name": 50, "category": 50},
    "dim_orders": {"payment_method": 30},
    "bronze": {"event_id": 36, "match_id": 50, "team": 100, "player": 100,
               "event_type": 50},
    "silver": {"match_id": 50, "team": 100, "event_type": 50},
    "orders": {"order_uuid": 255, "username": 100, "item_name": 100},
}
