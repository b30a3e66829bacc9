"""Operators for large-scale training-data preparation.

Nothing else in the library imports this package.  Each operator lives in a
module of its own and has a general interface (column names and limits are
parameters); ``catalog`` holds the thin registered queries on top of them.
"""

import sys

from pyspark import cloudpickle

# functions that run on executors travel with the task, so the package need
# not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
