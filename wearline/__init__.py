"""wearline: remaining-life analytics for monitored fleets, built on Spark DataFrames.

Every public operator takes and returns a DataFrame; the work runs on the cluster.
Sub-packages:

- ``sources``   text/Parquet readers and writers, request records
- ``operators`` labels, rolling windows, sequences, splits, scaling, metrics, comparison
- ``functions`` column-expression helpers (hashes, p-values, column lists)
- ``plans``     multi-step jobs (training, fleet scoring, model comparison) and the query catalog
- ``streaming`` request scoring on a streaming DataFrame
"""

__version__ = "0.1.0"
