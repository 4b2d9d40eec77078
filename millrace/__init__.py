"""Instruction-data preparation, scoring and drift monitoring as Spark jobs."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# The Arrow UDF bodies travel with the task, so executors need no installed copy.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
