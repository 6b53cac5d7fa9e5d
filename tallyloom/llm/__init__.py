"""Operators of a training-data pipeline: deduplication, search, packing, scoring, mixing, tokens."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the workers by value, so that a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
