"""Operators for preparing training text. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are sent whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
