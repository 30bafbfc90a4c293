"""domus — Spark-native operators for preparing, modelling and monitoring
transaction tables.

Every operator takes and returns lazy ``pyspark.sql.DataFrame`` objects; the
heavy lifting is done by Catalyst/Tungsten (joins, aggregates, windows) and
MLlib.  Only a handful of operators trigger a job while the plan is built
(size checks before a broadcast, one-hot category discovery, model fits);
those are documented on the function.
"""

from domus.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
