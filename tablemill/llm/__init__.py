"""Operators for training data: tokens, duplicates, filters and archives."""

import sys

from pyspark import cloudpickle

# What tasks need of this package travels with them, so executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
