"""Network flow analytics on Spark DataFrames.

``build_summaries`` turns flow records into windowed byte totals and top-K
tables; ``streaming`` runs the same code on Structured Streaming.
"""

import sys

from pyspark import cloudpickle

from netrill.config import FlowOptions
from netrill.plans.summaries import build_summaries

__all__ = ["FlowOptions", "build_summaries"]

# Functions that run in Python workers travel whole, so that executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
