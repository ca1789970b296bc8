"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# The functions that tasks run travel with them, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
