"""Panel time-series analytics on Spark.

A *panel* is a DataFrame ``(keys..., ds DATE, y DOUBLE)`` with at most one row
per series and day.  Every operator takes the series keys and returns a lazy
DataFrame.
"""

import sys

from pyspark import cloudpickle

# Small helpers used inside tasks travel with the task, so executors need no
# copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
