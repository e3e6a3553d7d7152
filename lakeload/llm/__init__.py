"""Operators for preparing training text, one module each; queries in ``queries.py``."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the tasks by value: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
