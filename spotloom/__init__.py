"""Spark-native analytics for multi-round imaging readouts and for the corpora around them."""

import sys

from pyspark import cloudpickle

# What tasks run travels with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
