"""Crosswalk analytics on Spark.

Functions of this package that run on executors travel by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
