"""quarry: DataFrame-native analytics operators on Spark.

Sub-packages:
  sources    -- scans (CSV family, Parquet, points) and sinks
  functions  -- column-expression helpers (string, array, geometry, time)
  operators  -- relational, graph, ranking, spatial and trend operators
  ml         -- feature stages, models, metrics as DataFrames
  streaming  -- Structured Streaming versions of the trend and scoring jobs
  plans      -- the query catalogue over the driver tables, plan checks
"""

__version__ = "0.1.0"
