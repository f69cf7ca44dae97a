"""Operators for preparing training data. Nothing else in the library imports this subpackage.

Its functions are sent to executors by value, so executors need the libraries it uses, but not the library itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
