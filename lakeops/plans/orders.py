"""Order messages -> orders table, first record per order id wins
(S4, P3, P18, W2, D2, J3, K3) in batch form; ``streaming.orders`` runs the
same steps per micro-batch.

A message is ``{"order_id", "user", "item", "quantity"}`` (JSON text or
bytes). Rows the target table would reject are quarantined with a reason
instead of stopping the job: not a JSON object, missing/NULL order_id, text
longer than the declared VARCHAR, or a quantity that is not an integer
value (a number 2.5 rounds to 3 as on insert into INTEGER; text must be an
integer, so "7" is 7 and "2.5" or "abc" are rejected).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.exprs import as_of_lit, coerce_int, json_object_shape, json_struct, variant_quoted, variant_text
from ..operators.joins import anti_join
from ..sinks.tables import rows_to_insert

KEY = ["order_uuid"]
LIMITS = schemas.MAX_LENGTH["orders"]


def decode(messages: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """Decode ``value`` into target columns plus ``reject_reason`` (NULL for
    good rows). ``order_cols`` (e.g. partition, offset) are carried along."""
    keep = order_cols or []
    text = F.col("value").cast("string")
    m = json_struct(text, schemas.ORDER_MESSAGE)
    df = messages.select(*keep, text.alias("value"), m.alias("m"))
    # a quoted quantity is integer text; a bare one is a number
    q_in = variant_text("m.quantity")
    qty = coerce_int(q_in, variant_quoted("m.quantity"))
    reason = (F.when(F.col("value").isNull(), F.lit("null message"))
              .when(~json_object_shape("value") | F.col("m").isNull(), F.lit("not a JSON object"))
              .when(F.col("m.order_id").isNull(), F.lit("missing order_id"))
              .when(F.length("m.order_id") > LIMITS["order_uuid"], F.lit("order_id too long"))
              .when(F.length("m.user") > LIMITS["username"], F.lit("user too long"))
              .when(F.length("m.item") > LIMITS["item_name"], F.lit("item too long"))
              .when(q_in.isNotNull() & qty.isNull(), F.lit("bad quantity")))
    return df.select(
        *keep, "value",
        F.col("m.order_id").alias("order_uuid"),      # P3 renames
        F.col("m.user").alias("username"),
        F.col("m.item").alias("item_name"),
        qty.alias("quantity"),
        reason.alias("reject_reason"))


def split(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined).

    Catalyst pushes these filters through the decode projection into the
    scan, where the predicate repeats the JSON parse for every field it
    reads. Persist ``decoded`` first when both sides are written (as the
    stream does per micro-batch), or use ``first_accepted`` for inserts."""
    ok = decoded.where(F.col("reject_reason").isNull()).drop("reject_reason", "value")
    bad = decoded.where(F.col("reject_reason").isNotNull())
    return ok, bad


def to_target(accepted: DataFrame, as_of=None) -> DataFrame:
    """Target columns with the ingest time stamp."""
    return accepted.select("order_uuid", "username", "item_name", "quantity",
                           as_of_lit(as_of, ntz=True).alias("created_at"))


def first_accepted(decoded: DataFrame, order_cols: list[str]) -> DataFrame:
    """D2 over decoded messages: per order id the first *accepted* record.

    Rejected records rank after accepted ones, and ids whose winner is
    rejected (no accepted record at all, or a NULL id) are dropped after the
    aggregate. Filtering accepted rows first would be pushed down through
    the decode projection into the scan, where the predicate repeats the
    JSON parse once per field it reads; a filter on the aggregate's output
    stays where it is, so each message is parsed once. ``min_by`` is a
    partial aggregate, so a hot id collapses map-side."""
    rest = ["username", "item_name", "quantity", "reject_reason", *order_cols]
    rank = F.struct(F.col("reject_reason").isNotNull().alias("_rejected"),
                    *[F.col(c) for c in order_cols])
    firsts = (decoded.groupBy(*KEY)
              .agg(F.min_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_w")))
    return (firsts.where(F.col("_w.reject_reason").isNull())
            .select(*KEY, *[F.col(f"_w.{c}").alias(c) for c in rest if c != "reject_reason"]))


def orders_to_insert(messages: DataFrame, existing: DataFrame | None,
                     order_cols: list[str], as_of=None,
                     small: bool = False) -> DataFrame:
    """K3 for one batch of messages: decode, first accepted record per order
    id by ``order_cols``, drop ids already in ``existing``."""
    firsts = first_accepted(decode(messages, order_cols), order_cols)
    if existing is None:
        return to_target(firsts, as_of)
    return to_target(anti_join(firsts, existing.select(*KEY), KEY, small), as_of)


def accepted_keys(messages: DataFrame, order_cols: list[str]) -> DataFrame:
    """The distinct order ids that have at least one accepted record (what a
    stored target holds after ingesting ``messages``)."""
    return first_accepted(decode(messages, order_cols), order_cols).select(*KEY)


def rows_to_insert_target(accepted: DataFrame, existing: DataFrame | None,
                          order_cols: list[str], as_of=None, small: bool = False) -> DataFrame:
    """K3 on already-decoded good rows (used per micro-batch). A batch whose ids
    are known to be ``small`` probes the stored target with a broadcast
    semi-join (the target is scanned, never shuffled)."""
    if existing is None:
        existing = accepted.limit(0).select(*KEY)
    return to_target(rows_to_insert(accepted, existing, KEY, order_cols, small), as_of)
