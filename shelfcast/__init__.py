"""Retail demand forecasting on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are shipped whole, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
