"""Operators of a training-data pipeline: one module per operator, queries in ``catalog``.

Task functions of this subpackage are shipped to the executors by value, so a
cluster needs numpy, pyarrow, xxhash and zstandard but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
