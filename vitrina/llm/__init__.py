"""Operators for large-scale training-data pipelines, built on Spark.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries when it can be imported.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that a cluster
# needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
