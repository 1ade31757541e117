"""estatelens — Spark-native property-market analytics.

Every transform is a ``DataFrame -> DataFrame`` function built from native
Spark SQL expressions so Catalyst can prune, push down and codegen it.
"""

__version__ = "0.1.0"
