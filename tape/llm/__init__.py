"""Operators for preparing training data at scale.

Nothing else in the library imports this package.  Functions that run inside
Python workers are shipped by value, so executors need numpy, pyarrow and
zstandard but no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
