"""Operators for large text corpora (training-data preparation).

Nothing else in the library imports this package. The functions that run in
Python workers are shipped by value, so executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
