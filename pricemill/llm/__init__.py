"""Operators of a training-data pipeline over documents and web pages, as Spark DataFrame functions.

Functions that run on executors travel with the job, so the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
