"""Operators for text and model data. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package run in Python workers that may not have it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
