"""Operators for preparing training text; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Tasks get these functions themselves, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
