"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this package. Functions that run in Python workers travel with
their tasks, so executors need no copy of the library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
