"""Training-data operators: one module per operator, ``registry`` with their queries and SQL."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
