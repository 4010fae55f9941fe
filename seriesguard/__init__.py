"""seriesguard: Spark-native anomaly and drift detection over many time series at once.

Every operator is a function ``DataFrame -> DataFrame`` that works per series (``keys``) and is
chained with ``DataFrame.transform``. Only parameter rows, counts and model weights reach the driver.
"""

__version__ = "0.1.0"
