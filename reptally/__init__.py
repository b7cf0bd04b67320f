"""Cleaning and summarising of replicated count tables on Spark.

Every operator takes and returns DataFrames in one long, sparse form: one row
per (run, sample, feature) with a positive count in ``reads``.
"""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the job, so that executors need no copy
# of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
