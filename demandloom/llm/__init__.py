"""Operators for preparing large training corpora.

Nothing outside this package imports it. Functions of its modules that run in
Python workers travel by value, so executors need no copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
