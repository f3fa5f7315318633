"""sluice: a change-data relay and change-log toolkit on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their code, so executors
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
