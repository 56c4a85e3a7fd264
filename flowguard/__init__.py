"""Spark-native anomaly detection over network-flow, connection-log and system-log data."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
