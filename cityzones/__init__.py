"""cityzones: a Spark-first library for a city rental / income / incident lakehouse.

Layers:

* ``sources``   - readers for the landing zone (JSON lines, CSV, nested Parquet
                  snapshot folders, lookups) and the sinks (Parquet, CSV, JDBC).
* ``functions`` - column expressions (quotes, splits, names, casts, keys).
* ``operators`` - DataFrame-in / DataFrame-out building blocks (filters,
                  generators, dedupe, reconcile joins, aggregations, partitioning).
* ``plans``     - the composite jobs: formatters, indicator tables, ML dataset,
                  model training / versioning / evaluation.
* ``streaming`` - incremental landing-zone ingestion on Structured Streaming.

Everything is expressed with the DataFrame API so Catalyst plans it; there are
no RDDs and no Python UDFs on the data path.
"""

__version__ = "0.1.0"
