"""weirgate: ingestion, quality and refinement of semi-structured data on Spark.

Every operator takes and returns DataFrames or Columns.  Nothing row-sized passes
through the driver: it only sees counts, verdicts and bounded lists (bucket ids,
dataset specs).
"""

__version__ = "0.1.0"
