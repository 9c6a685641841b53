"""Spark-native refinement of scanned-document text."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# functions of this package travel to the executors themselves, which need not have it installed
register_pickle_by_value(sys.modules[__name__])
