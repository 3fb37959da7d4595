"""Operators of a training-data pipeline: deduplication, search, tokens, filters, packing.

Nothing else in the library imports this subpackage.  Functions that run in
executors are sent by value, so that executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
