"""Manual-knowledge analytics expressed as Spark DataFrame programs."""

import sys

from pyspark import cloudpickle

# Functions travel to executors by value, so these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
