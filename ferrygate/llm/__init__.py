"""Operators for large training-text corpora.

Functions that run in Python workers travel by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
