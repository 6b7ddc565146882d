"""Operators for large-scale training-data pipelines (one module per operator).

Functions that run inside tasks are pickled by value, so executors need only
the public libraries, not a copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
