"""Column-level helpers: every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from riskpanel.functions.scalar import *  # noqa: F401,F403
