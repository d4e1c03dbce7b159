"""Folioloom: a PySpark engine for building training datasets out of annotated documents.

Functions of this package travel to executors by value, so a cluster needs no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
