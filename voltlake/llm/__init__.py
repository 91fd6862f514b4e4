"""Operators for training-data pipelines (tokenising, packing, near copies,
filters). Nothing else in the library imports this package.

Functions of this package that run inside tasks are shipped by value, so
executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
