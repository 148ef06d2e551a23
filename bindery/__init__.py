"""A Spark-native engine for catalogue extraction, keyed merges and text corpora."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions with the task, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
