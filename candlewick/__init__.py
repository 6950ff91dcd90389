"""Market time series on Spark: bars, ticks, indicators, VWAP, and the jobs that tie them together."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so that executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
