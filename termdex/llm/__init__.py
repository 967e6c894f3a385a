"""Operators of a training-data pipeline over text tables.

Each module is one operator; ``queries`` registers them. Nothing else in the library
imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the task, so a worker needs no
# copy of the package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
