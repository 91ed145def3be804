"""Operators for preparing training text: filters, deduplication, classifiers, token counts, packing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
