"""Operators for building training data from text."""

import sys

from pyspark import cloudpickle

# Python code that runs in tasks travels with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
