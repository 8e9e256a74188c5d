"""Prepare, encode, split, profile and classify catalogue-style text records on Spark.

Every operator takes and returns ``DataFrame``; the caller owns the session.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job: nothing to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
