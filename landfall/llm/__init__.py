"""Operators for preparing training data: sharding, mixing, deduplication, filtering, archives, chat formats.

Functions that run in Python workers travel by value, so a cluster needs no copy of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
