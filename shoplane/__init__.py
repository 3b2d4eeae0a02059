"""shoplane: a Spark-native build of a retail web-shop analytics model set.

Layers: raw sources (CSV / year-month partitioned Parquet) -> silver
(``dim_products``, ``fct_sales``, ``fct_sessions``) -> gold daily marts with a
seven-day incremental merge, plus declared data-quality checks.
"""

__version__ = "0.1.0"
