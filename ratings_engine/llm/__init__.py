"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
