"""tidewater: a Spark-native retail sales warehouse.

Layers (source -> mirror -> staging -> warehouse) are DataFrames written as
versioned Parquet tables.  Every step is a set-based Spark plan: incremental
extract by high-water mark, idempotent upserts, cleaning, SCD type 2
dimensions, distributed surrogate keys, a keyed sales fact and the metric,
quality and run-log queries on top.
"""

__version__ = "0.1.0"
