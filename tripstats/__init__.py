"""tripstats: per-company statistics of hotel and flight reservations on PySpark.

Layout
------
schemas      message, dimension and statistic-table schemas (the data model)
functions    column expressions (money, calendar, text, numbers)
operators    DataFrame -> DataFrame building blocks (lookup, rollup, statistics, ...)
sources      message decoding, dimensions, the parquet store of partials and totals
plans        reports, profiles and the registered queries over the given tables
streaming    the Structured Streaming job that feeds the store
"""

__version__ = "0.1.0"
