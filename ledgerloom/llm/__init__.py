"""Operators for training-data corpora: one module per operator, thin queries in ``queries``.

The functions that run inside tasks are sent to the executors by value, so a cluster needs numpy,
pandas and pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
