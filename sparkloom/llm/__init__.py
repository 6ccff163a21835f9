"""Operators for building training data: sharding, scoring, joins, mixing, packing, search.

Functions of this package that run inside tasks travel with the task, so executors
need numpy, pandas and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
