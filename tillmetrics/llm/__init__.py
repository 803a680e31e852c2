"""Operators that turn a crawl into training data. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the executors with their code, so that a driver that runs
# from a checkout needs nothing installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
