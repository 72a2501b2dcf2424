"""Operators for preparing large text collections for language-model training."""

import sys

from pyspark import cloudpickle

# Task-side code travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
