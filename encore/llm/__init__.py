"""Operators of a training-data pipeline over document, benchmark and chat tables."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the tasks by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
