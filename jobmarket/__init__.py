"""Spark-native analytics over job postings: DataFrame in, DataFrame out, no global session."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
