"""Procurement analytics on Spark: landing files to typed tables, history, marts and search."""

import sys

from pyspark import cloudpickle

# Functions go to the Python workers by value: a cluster needs no copy of this package on its machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
