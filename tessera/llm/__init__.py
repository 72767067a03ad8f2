"""Operators for preparing training data.

One module per operator; ``queries`` holds the registered queries and their SQL.
Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so that executors
# need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
