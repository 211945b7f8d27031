"""riskframe — loan-risk data processing as Spark DataFrame jobs.

Sub-packages:
  sources    scans and sinks (CSV/parquet/JSON reports, model directories)
  functions  column-expression builders (no Spark job on their own)
  operators  DataFrame -> DataFrame operators (profiling, statistics,
             sampling, quality, drift, metrics, ML, scoring)
  plans      inputs derived from the driver tables and the query catalog
  streaming  Structured Streaming versions of the windowed monitors
"""

__version__ = "0.1.0"
