"""Operators for preparing training text. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors whole, which need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
