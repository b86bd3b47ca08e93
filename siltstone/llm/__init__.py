"""Operators for large-scale training-data pipelines; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Executors receive the functions by value: the library need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
