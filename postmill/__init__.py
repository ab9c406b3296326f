"""Spark-first engine for collecting, matching and deduplicating address data."""

import sys

from pyspark import cloudpickle

#: Functions sent to executors carry their code along, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
