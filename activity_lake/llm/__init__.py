"""Operators of a training-data pipeline; nothing else in the package imports them.

Their functions travel to the executors with the job, so that these need no installation of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
