"""Training-data operators on whole tables; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# the Python functions travel with the job, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
