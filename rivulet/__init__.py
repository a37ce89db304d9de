"""rivulet: lazy Spark DataFrame operators for a bronze/silver/gold data lake.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column`` for scalar functions) and never pulls data to the driver.
"""

__version__ = "0.1.0"
