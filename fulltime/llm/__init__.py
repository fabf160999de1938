"""Operators for large text collections: tokenisation, search, joins, mixing, scoring, extraction.

Nothing outside this package imports it. Functions of this package that run in Python workers are
shipped by value, so executors need not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
