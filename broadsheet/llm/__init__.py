"""Operators for preparing training text, at corpus scale.

Functions of this package that run in tasks travel with them, so executors need no copy of it.
What is broadcast is made of built-in types and arrays for the same reason.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
