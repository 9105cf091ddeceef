"""Document and event-log analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: they need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
