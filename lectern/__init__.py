"""Lectern: a PySpark-native catalogue record-linkage and search engine."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions travel to executors by value, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
