"""recordmill: record cleaning, duplicate resolution and page extraction as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions travel with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
