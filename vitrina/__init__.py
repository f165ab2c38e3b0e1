"""vitrina: retail medallion operators expressed as Spark DataFrame plans.

Every operator is a ``Column -> Column`` or ``DataFrame -> DataFrame``
function built from ``pyspark.sql.functions``; none of them starts a Python
UDF, so all work stays in whole-stage codegen on the executors.
"""

__version__ = "0.1.0"
