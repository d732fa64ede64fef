"""Operators for building training corpora.

Each module holds one operator with its general interface; ``queries`` applies
them to the driver's tables.  Nothing else in the library imports this package.

Functions of this package that run in Spark's Python workers are pickled by
value, so executors need not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
