"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with their tasks, so the executors need no
# installed copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
