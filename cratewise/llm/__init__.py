"""Operators for preparing training data, and their queries."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions by value: executors needn't have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
