"""Training-data operators.  Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
