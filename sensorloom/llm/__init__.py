"""Operators of a training-data pipeline. Task code goes to executors by value, so that they
need no copy of the package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
