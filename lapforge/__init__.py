"""lapforge: season-based competition results analytics on Spark.

Sub-packages:
  sources    readers (parquet tables, raw CSV, text logs)
  functions  Column -> Column helpers (points table, half-even rounding, parsers)
  operators  DataFrame -> DataFrame building blocks (ordering, aggregates, joins,
             cleaning, quality checks)
  plans      the composite queries over the model frames, their SQL oracles and
             the registry used by ``__spark_entry__``
  sinks      writers (overwrite, append, versioned merge, export)
  streaming  file-stream landing and mart refresh
"""

__version__ = "0.1.0"
