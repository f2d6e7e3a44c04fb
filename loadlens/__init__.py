"""loadlens: Spark-native analytics over tables of load-test runs.

Every operator is a ``DataFrame -> DataFrame`` function (or a small
``fit`` that returns constants plus a ``transform``) so plans stay lazy
and Catalyst sees the whole query.
"""

__version__ = "0.1.0"
