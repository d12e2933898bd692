"""A Spark-native engine that turns document text into linked, gated facts."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so they need no copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
