"""Find, describe and report the themes of large multilingual comment tables on Spark."""

import sys

from pyspark import cloudpickle

from voxloom.settings import Settings

# Functions sent to the tasks carry the code of this package along, so that executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Settings"]
