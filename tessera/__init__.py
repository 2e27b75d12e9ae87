"""tessera: taxi-trip and complaint-text analytics as plain PySpark jobs.

Every public function maps DataFrames to DataFrames (or Columns to Columns)
and is composed with ``DataFrame.transform``; Catalyst, Tungsten and MLlib do
the execution.
"""

import sys

from pyspark import cloudpickle

from tessera.session import get_spark, shared_path

__all__ = ["get_spark", "shared_path"]

# Functions that run in Python workers travel by value, so executors need no
# copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
