"""Operators for preparing large text corpora. Nothing else in the library imports this package.

Code that runs in Python workers travels with the tasks, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
