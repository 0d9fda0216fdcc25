"""G7 / O3 over the supplied orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import testdata as td
from .. import datagen
from .base import register


# --------------------------------------------------------------------------
# Shipments for an exact third of the orders: the third of smallest
# seeded hash, with every value drawn from a seeded hash of the id
# --------------------------------------------------------------------------

SEED, AS_OF = 42, "2024-02-01 00:00:00"


def _draw(tag: str) -> str:
    return f"(('0x' || substr(md5('{SEED}|{tag}|' || id), 1, 13))::BIGINT::DOUBLE / 4503599627370496)"


@register("shipment_sample", f"""
WITH ranked AS (
  SELECT o_orderkey AS id, row_number() OVER (ORDER BY
           ('0x' || substr(sha256(length(o_orderkey::VARCHAR) || ':' || o_orderkey || '|{SEED}'), 1, 15))::BIGINT,
           o_orderkey) AS place
  FROM orders),
sample AS (SELECT id, CAST(TIMESTAMP '{AS_OF}' - to_seconds(CAST(floor({_draw("pickup")} * (90 * 86400 + 1)) AS BIGINT))
                           AS DATE) AS pickup_date
           FROM ranked WHERE place <= (SELECT count(*) // 3 FROM orders))
SELECT id AS shipment_id, id AS order_item_id,
       CAST(round(5.0 + {_draw("ship")} * 45.0, 2) AS DECIMAL(10, 2)) AS shipping_cost,
       pickup_date, pickup_date + CAST(1 + floor({_draw("days")} * 7) AS INTEGER) AS delivery_date,
       {_draw("ontime")} < 0.9 AS on_time_delivery, {_draw("damage")} < 0.01 AS damage_reported,
       TIMESTAMP '{AS_OF}' AS created_at
FROM sample
""")
def q_shipment_sample(spark, d):
    items = td.table(spark, d, "orders").select(F.col("o_orderkey").alias("order_item_id"))
    return datagen.shipments(items, seed=SEED, as_of=AS_OF)
