"""Operators of a training-data pipeline on the tables documents, pages and labels; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
