"""Analytics over tables and streams, written as DataFrame -> DataFrame functions."""

import sys

from pyspark import cloudpickle

# Functions run inside tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
