"""Operators for preparing training data at scale; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Ship the functions that run in tasks with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
