"""Operators of a training-data pipeline. Worker functions travel with their code, so executors need no copy."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
