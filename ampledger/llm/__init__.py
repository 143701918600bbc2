"""Operators for training-data pipelines. Nothing else in the library imports this package.

Functions that run in tasks travel with the job, so that executors need no
installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
