"""Operators for large training-data tables."""

import sys

from pyspark import cloudpickle

# Functions go to the executors with their code, so that no package need be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
