"""Spark-native clickstream analytics: validation, cleaning, metrics, warehouse and serving.

Every public function takes and returns DataFrames; the heavy work is expressed with
built-in Spark SQL functions so Catalyst can prune, push down and plan it.
"""

__version__ = "0.1.0"
