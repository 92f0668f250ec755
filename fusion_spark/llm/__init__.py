"""Operators that prepare training text: extraction, tokens, dedup, classifiers, packing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so nothing has to be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
