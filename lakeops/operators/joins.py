"""Join helpers.

Broadcasting is only ever decided behind a size check in bytes: either Catalyst's
own (``autoBroadcastJoinThreshold`` on file statistics, re-checked by AQE with
runtime sizes) or ``key_bytes`` of a batch that the caller holds persisted.
Beyond the bound the join stays a shuffle (sort-merge) join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PROBE_BYTES = 64 << 20


def key_bytes(df: DataFrame, keys: list[str]) -> int:
    """Bytes of all keys of ``df``, with 32 for each row: one partial
    aggregate. Persist ``df`` first where it is costly to make."""
    each = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(32))
    return df.agg(F.sum(each.cast("long"))).first()[0] or 0


def anti_join(new: DataFrame, existing: DataFrame, keys: list[str], small: bool = False) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` (NULL keys never
    match, as in SQL NOT EXISTS on equality).

    A left anti join can only broadcast its right side, so a huge
    ``existing`` (all history) would be shuffled for every small batch. A caller
    that knows the keys of ``new`` to be ``small`` (``key_bytes`` up to
    MAX_PROBE_BYTES) has them broadcast into a semi-join that *scans*
    ``existing`` without shuffling it; the few keys found are then anti-joined."""
    ex = existing.select(*keys)
    if small:
        probe = F.broadcast(new.select(*keys).distinct())
        return new.join(ex.join(probe, keys, "left_semi"), keys, "left_anti")
    return new.join(ex, keys, "left_anti")
