"""Operators of a training-data pipeline: one module per operator, ``queries`` and ``oracles`` for the driver.

Functions that run inside tasks are sent to the executors by value, so those need no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
