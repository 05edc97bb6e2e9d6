"""Operators for training data: fingerprints, duplicates, extraction, classifiers, mixing.

Functions of this package travel to the tasks by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
