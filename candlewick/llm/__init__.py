"""Operators for large-scale training-data pipelines (one module per operator).

Functions of this subpackage run inside Python workers. They are shipped by
value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
