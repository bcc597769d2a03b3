"""Spark-native feature, sequence and recommendation-data jobs."""

import sys

from pyspark import cloudpickle

from seqloom.session import build_session

# functions that run in Python workers travel with their code, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session"]
__version__ = "0.1.0"
