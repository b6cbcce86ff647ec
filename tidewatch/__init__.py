"""Status, liveness, capacity and settings tables from event logs, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their code, so executors need not
# have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
