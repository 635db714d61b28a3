"""Registry of named queries: each has a Spark builder over the bound tables
and (where SQL can say it) the same query as DuckDB SQL for the oracle check.

Importing this package registers every query module.
"""

from riskpanel.catalog.base import REGISTRY, oracle_sql, queries, run  # noqa: F401
from riskpanel.catalog import (  # noqa: F401,E402
    q_scans, q_filters, q_joins, q_aggs, q_windows, q_sorts, q_reshape, q_scalars,
    q_quality, q_forecast, q_state, q_streams, q_jobs,
)
