"""Spark-native lakehouse engine for order systems, plant-floor telemetry and training corpora."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.2.0"
