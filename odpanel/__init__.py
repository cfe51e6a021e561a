"""odpanel: origin-destination flow panels and quarterly index numbers on PySpark.

Every public function takes and returns DataFrames (or Columns) and is built
from built-in Spark SQL expressions only, so Catalyst sees the whole plan:
filters and column pruning reach the parquet scan, aggregates run partial
(map-side) before their shuffle, and nothing is pulled to the driver.

Sub-packages
------------
sources    readers for the driver tables, the derived panels, CSV, record
           files and cell grids; sinks (CSV, managed tables)
functions  Column-level helpers (safe division, cell cleaning, label rules,
           typed literal parsing)
operators  DataFrame -> DataFrame operators (cleaning, flows, normalization,
           index numbers, profiling, grid extraction, quality checks)
plans      composite products (corridor ranking, margin index) and the query
           catalogue used by ``__spark_entry__``
"""

__version__ = "0.1.0"
