"""opinia: text classification and corpus analytics for large collections of short labelled texts, on PySpark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run inside Python workers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
