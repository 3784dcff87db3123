"""Operators for preparing training data: filters, deduplication, search, sampling and archives.

Functions of this package that run on executors are pickled by value, so workers do not need
to find the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
