"""Suspicious-transaction analytics as composable Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors get the few Python functions they run by value, so they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
