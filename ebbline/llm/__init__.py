"""Operators for training-data pipelines.

Nothing else in the library imports this part.  Its Python code travels to the
executors by value, so a job needs no copy of it there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
