"""cellweave: spatial-omics table operators for Spark.

A count matrix is a long table ``x(cell_id, gene, value)`` that holds only its
non-zero entries, next to ``obs`` (one row per cell) and ``var`` (one row per
feature).  Every operator takes and returns DataFrames.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Task functions travel with the job, so executors need no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
