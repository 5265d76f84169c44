"""Operators for preparing language-model training data. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so these need the library's dependencies but not the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
