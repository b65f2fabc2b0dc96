"""Operators for training-data pipelines. Nothing else in the package imports this folder.

Task code is shipped by value, so executors need the public libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
