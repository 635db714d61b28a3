"""riskpanel: district outbreak-risk analytics written as Spark DataFrame jobs.

Subpackages:
  functions  - Column-level helpers (severity, clamps, calendar parts, rounding)
  sources    - readers, writers and the bindings of the driver's test tables
  operators  - filters, joins, aggregates, windows, quality rules, forecasts, state
  plans      - composed jobs (training panel, statistics, predictions, daily and weekly jobs)
  streaming  - Structured Streaming re-aims of row-at-a-time ingest and alerting
"""

__version__ = "0.1.0"
