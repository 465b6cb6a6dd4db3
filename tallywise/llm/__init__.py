"""Operators for preparing training text. Nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Tasks get this folder's functions with the plan, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
