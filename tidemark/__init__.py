"""tidemark: Spark-native monthly demand features, forecasting and error analytics.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from the
DataFrame/SQL API, so Catalyst plans it and the cluster scales it.
"""

__version__ = "0.1.0"
