"""Scalar expressions P6-P18. Every helper returns a ``Column`` made of
built-in functions, so it stays inside whole-stage codegen."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_of_lit", "null_default", "ilike", "flag_to_int", "is_expired",
    "plus_interval", "parse_iso", "format_iso", "json_struct", "json_field",
    "json_object_shape", "variant_text", "variant_quoted", "key_text", "stable_id", "coerce_int", "col_", "epoch_micros",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_lit(as_of, ntz: bool = False) -> Column:
    """A fixed point in time as a literal (taken as an argument so reruns
    repeat; one value for the whole statement, like NOW())."""
    if as_of is None:
        return F.localtimestamp() if ntz else F.current_timestamp()
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp_ntz" if ntz else "timestamp")
    if isinstance(as_of, _dt.datetime):
        if ntz:
            return F.lit(as_of.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
        return F.lit(as_of).cast("timestamp")
    return as_of


def null_default(c, value: Column) -> Column:
    """COALESCE(c, value)."""
    return F.coalesce(col_(c), value)


def ilike(c, pattern: str) -> Column:
    """Case-insensitive LIKE; NULL input is no match (false)."""
    return F.coalesce(col_(c).ilike(pattern), F.lit(False))


def flag_to_int(c) -> Column:
    """CASE WHEN c = TRUE THEN 1 ELSE 0 END (NULL -> 0)."""
    return F.when(col_(c), 1).otherwise(0)


def is_expired(expires_at, now: Column) -> Column:
    """P10: strictly before now; equal is still valid."""
    return col_(expires_at) < now


def plus_interval(c, interval: str = "1 HOUR") -> Column:
    """Timestamp + INTERVAL."""
    return col_(c) + F.expr(f"INTERVAL {interval}")


def parse_iso(c) -> Column:
    """ISO-8601 text (with offset, with or without micros) -> timestamp.
    Bad text gives NULL."""
    return col_(c).try_cast("timestamp")


def format_iso(c) -> Column:
    """Timestamp -> ISO-8601 text with a UTC offset (isoformat style)."""
    return F.date_format(col_(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def json_struct(c, schema) -> Column:
    """JSON object text -> struct. Single quotes are not JSON."""
    return F.from_json(col_(c), schema, {"allowSingleQuotes": "false"})


def json_field(c, field: str) -> Column:
    """One top-level field as text."""
    return F.get_json_object(col_(c), f"$.{field}")


def json_object_shape(c) -> Column:
    """True when the text looks like one JSON object: rejects arrays, bare
    scalars, trailing text after the closing brace (``{..} x``) and two
    objects back to back (``{..}{..}``). ``from_json`` alone would accept the
    last two by decoding the first object. In valid JSON a ``}`` is never
    directly followed by ``{`` outside string literals, so string literals
    are blanked first and that pair is rejected."""
    c = col_(c)
    # possessive: the pattern neither backtracks nor recurses on long strings
    no_strings = F.regexp_replace(c, r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"', '""')
    return F.coalesce(c.rlike(r"(?s)\A\s*+\{.*\}\s*\z") & ~no_strings.rlike(r"\}\s*+\{"),
                      F.lit(False))


def variant_text(v) -> Column:
    """A variant's value as text (objects and arrays as JSON, JSON null as
    NULL), as ``from_json`` gives it for a string field."""
    return F.try_variant_get(col_(v), "$", "string")


def variant_quoted(v) -> Column:
    """True when a variant was a JSON string, so that ``7`` and ``"7"`` can be
    told apart with no second look at the document."""
    return F.coalesce(F.schema_of_variant(col_(v)) == "STRING", F.lit(False))


def key_text(*cols) -> Column:
    """Key columns as one text that differs wherever the keys differ: every
    value with its length, NULL as ``n``."""
    texts = [col_(c).cast("string") for c in cols]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("n"))
                      for t in texts])


def stable_id(*cols) -> Column:
    """A deterministic id from key columns (stable on task retry, unlike
    uuid()); NULLs and the columns' borders count."""
    return F.sha2(key_text(*cols), 256)


def coerce_int(c, quoted: Column | None = None) -> Column:
    """A JSON value coerced to INTEGER as on insert into an INTEGER
    column. A JSON number is rounded half away from zero (2.5 -> 3); a JSON
    string must be integer text ("7", " +7 " -> 7; "2.5", "abc" -> NULL);
    true/false and out-of-range values -> NULL. ``quoted`` tells whether the
    value was a JSON string (``variant_quoted``); without it every value is
    treated as a number. The caller
    treats NULL from a non-NULL input as a rejected row."""
    c = col_(c)
    as_number = F.round(c.try_cast("decimal(38,18)")).try_cast("int")
    if quoted is None:
        return as_number
    as_text = F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(c).try_cast("int"))
    return F.when(quoted, as_text).otherwise(as_number)


def epoch_micros(c, ntz: bool) -> Column:
    """Microseconds since 1970-01-01 as a long. For ``timestamp_ntz`` it is
    computed from the date and the time of day, so the session time zone
    (and its DST gaps) never enters; for ``timestamp`` it is ``unix_micros``."""
    c = col_(c)
    if not ntz:
        return F.unix_micros(c)
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.extract(F.lit("SECOND"), c)                      # decimal(8,6), with micros
    return (days * F.lit(86_400_000_000)
            + F.hour(c).cast("long") * F.lit(3_600_000_000)
            + F.minute(c).cast("long") * F.lit(60_000_000)
            + (secs * F.lit(1_000_000)).cast("long"))
