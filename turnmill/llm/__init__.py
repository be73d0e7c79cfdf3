"""Operators for training-data pipelines over tables of documents, pages and conversations.

Nothing outside this package imports it, and it can be taken out as a whole.
"""

import sys

from pyspark import cloudpickle

# Functions of this package reach the workers by value, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
