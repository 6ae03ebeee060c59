"""Chalkline: school-records rescue and analytics as lazy Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
