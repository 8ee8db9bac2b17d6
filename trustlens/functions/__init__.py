"""Column expressions over review fields and texts.

Functions that run inside Spark tasks are sent with the job itself, so the
executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
