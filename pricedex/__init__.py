"""pricedex — consumer-price-index analytics as Spark jobs.

Layers:
  sources/    readers for the raw file formats, stand-in raw tables over the driver tables, sinks
  functions/  Column-level helpers (parsing, labels, exact rounding)
  operators/  DataFrame -> DataFrame operators (cleaning, normalisation, analytics, windows, forecasting)
  streaming/  request-log metrics, identical code for batch and Structured Streaming
  plans/      the named query catalogue (Spark plans + DuckDB oracle SQL)
"""

__version__ = "0.1.0"
