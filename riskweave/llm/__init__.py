"""Operators for preparing training text: deduplication, counts, filters, mixing, files.

Nothing else in the library imports this package. Its task functions are pickled
by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
