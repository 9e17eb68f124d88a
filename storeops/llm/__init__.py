"""Operators of a training-data pipeline over documents, web pages and labels."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their tasks, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
