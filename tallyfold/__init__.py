"""tallyfold: analytics over business tables, written as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions sent to executors carry their code, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
