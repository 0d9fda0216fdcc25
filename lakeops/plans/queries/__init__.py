"""Registered queries over the supplied test tables, with DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built by the
library's jobs on whole tables; floating results are rounded on both sides.
One module per area; importing the package registers them all.
"""

# import order = registration order
from . import star_reports  # noqa: F401
from . import match_events  # noqa: F401
from . import ticket_log  # noqa: F401
from . import order_messages  # noqa: F401
from . import audits  # noqa: F401
from . import generator  # noqa: F401
from . import streams  # noqa: F401
from . import keyed_streams  # noqa: F401
from . import kept_reports  # noqa: F401
from .base import ORACLE_SQL, QUERIES, register  # noqa: F401
