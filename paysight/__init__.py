"""paysight: compensation-survey analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or a small fitted
object holding scalars) built from Spark's own expressions and ``pyspark.ml``.
The caller owns the ``SparkSession``; the library never creates one.
"""

__version__ = "0.1.0"
