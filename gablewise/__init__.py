"""Property-audit analytics on Spark, with operators for training corpora beside them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that those need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
