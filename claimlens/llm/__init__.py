"""Operators of a training-data pipeline; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: no executor needs the package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
