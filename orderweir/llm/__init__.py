"""Operators for building training data: scoring, filtering, de-duplication, mixing, sharding.

Nothing else in the library imports this package. Functions that run in Python
tasks travel by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
