"""Operators for preparing training data, and their queries. Nothing else in the library imports this package.

Functions that run in tasks are sent with the job, so executors need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
