"""Spark-native record linkage engine.

Functions that run inside Python workers are pickled by value, so a cluster
needs neither this package on its executors nor a shipped archive.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
