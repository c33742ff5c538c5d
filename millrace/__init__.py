"""Spark-native analytics operators: cleaning, profiling, statistics, series, models, alerts."""

import sys

from pyspark import cloudpickle

# Python helpers travel inside the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
