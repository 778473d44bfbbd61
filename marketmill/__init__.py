"""marketmill: a commerce warehouse expressed as Spark DataFrame functions.

Functions that run in Python workers are sent along with the job, helpers included, so
executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
