"""M1-M4 medallion over events."""

from __future__ import annotations

from ...sources import testdata as td
from .. import medallion
from .base import register, run_dir


# --------------------------------------------------------------------------
# M1-M4 medallion over events (day = match, user = team, props = player)
# --------------------------------------------------------------------------

_SRC_SQL = """
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS match_id,
       CAST(user_id AS VARCHAR) AS team,
       props AS player,
       event_type,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS event_ts
FROM events
"""

AS_OF = "2024-02-01 00:00:00"


def _silver_sql(src: str) -> str:
    """Distinct rows by grouping; a NULL time becomes the run's time first."""
    return f"""
SELECT match_id, team, event_type, filled AS "timestamp"
FROM (SELECT *, CASE WHEN event_ts IS NULL THEN TIMESTAMP '{AS_OF}' ELSE event_ts END AS filled FROM ({src}) s0) s1
WHERE event_type IS NOT NULL GROUP BY match_id, team, event_type, filled
"""


def _gold_sql(src: str, patterns: dict[str, str]) -> str:
    """One sum per metric, from the pattern table that the job uses."""
    sums = ", ".join(f"CAST(SUM(CASE WHEN lower(event_type) LIKE '{p}' THEN 1 ELSE 0 END) AS BIGINT) AS {n}"
                     for n, p in patterns.items())
    return f"SELECT team, {sums} FROM ({_silver_sql(src)}) s GROUP BY team"


_SILVER_SQL = _silver_sql(_SRC_SQL)
EVENT_PATTERNS = {"total_clicks": "%click%", "total_errors": "%error%", "total_ups": "%up%"}


def _bronze(spark, d):
    return medallion.bronze(td.match_events(spark, d))


def _silver(spark, d):
    return medallion.silver(_bronze(spark, d), as_of=AS_OF)


@register("bronze_events", f"""
SELECT event_id, match_id, team, player, event_type, event_ts AS "timestamp" FROM ({_SRC_SQL}) s
""")
def q_bronze_events(spark, d):
    return _bronze(spark, d)


@register("silver_events", _SILVER_SQL)
def q_silver_events(spark, d):
    return _silver(spark, d)


@register("gold_stats", _gold_sql(_SRC_SQL, medallion.GOLD_PATTERNS))
def q_gold_stats(spark, d):
    return medallion.gold(_silver(spark, d))


@register("gold_event_counts", _gold_sql(_SRC_SQL, EVENT_PATTERNS))
def q_gold_event_counts(spark, d):
    return medallion.gold(_silver(spark, d), EVENT_PATTERNS)


@register("layer_counts", f"""
SELECT 'bronze' AS layer, COUNT(*) AS row_count FROM events
UNION ALL
SELECT 'silver' AS layer, COUNT(*) AS row_count FROM ({_SILVER_SQL}) s
UNION ALL
SELECT 'gold' AS layer, COUNT(*) AS row_count
FROM (SELECT team FROM ({_SILVER_SQL}) s2 GROUP BY team) g
""")
def q_layer_counts(spark, d):
    b = _bronze(spark, d)
    s = medallion.silver(b, as_of=AS_OF)
    return medallion.layer_counts(b, s, medallion.gold(s))


# --------------------------------------------------------------------------
# The layers as stored by a whole run, over a source with NULL types and times
# and with types that the gold patterns match in any case
# --------------------------------------------------------------------------

_MATCH_SQL = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS match_id,
       CASE WHEN user_id % 11 <> 0 THEN CAST(user_id AS VARCHAR) END AS team, props AS player,
       CASE event_type WHEN 'click' THEN 'Goal' WHEN 'view' THEN 'SHOT on goal' WHEN 'purchase' THEN 'foul'
                       WHEN 'error' THEN 'offside' END AS event_type,
       CASE WHEN event_id % 7 <> 0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS event_ts
FROM events
"""


def _stored(spark, d, layer):
    run = run_dir(spark, f"medallion-{layer}")
    medallion.run(td.match_events_with_gaps(spark, d), run, as_of=AS_OF)
    return medallion.read_layer(spark, run, layer)


@register("stored_bronze", f"""
SELECT event_id, match_id, team, player, event_type, event_ts AS "timestamp" FROM ({_MATCH_SQL}) s
""")
def q_stored_bronze(spark, d):
    return _stored(spark, d, "bronze")


@register("stored_silver", _silver_sql(_MATCH_SQL))
def q_stored_silver(spark, d):
    return _stored(spark, d, "silver")


@register("stored_gold", _gold_sql(_MATCH_SQL, medallion.GOLD_PATTERNS))
def q_stored_gold(spark, d):
    return _stored(spark, d, "gold")
