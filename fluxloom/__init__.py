"""fluxloom: ecosystem and tower time series as Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions that run inside tasks travel by value, so that
# executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
