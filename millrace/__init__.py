"""Millrace: a PySpark-native engine for preparing conversation and task-trace datasets."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value, so a worker needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
