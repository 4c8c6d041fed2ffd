"""Operators of a training-data pipeline: near duplicates, filters, archives,
tokenizing.  Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that these
# need no copy of the repository on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
