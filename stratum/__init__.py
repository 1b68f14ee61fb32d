"""stratum: top-down regional allocation, raking and interpolation on Spark.

Every operator takes and returns DataFrames and carries the run keys
(``scenario``, ``scheme``) through every join, aggregation and window, so
many scenarios and grouping schemes run in one job.
"""

__version__ = "0.1.0"
