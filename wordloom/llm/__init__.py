"""Operators for preparing training data; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Executors need not have the library on their path: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
