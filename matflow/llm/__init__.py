"""Training-data operators: filters, deduplication, classifiers, sharding and tokenisation of documents.

Functions of this package travel to the executors by value, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
