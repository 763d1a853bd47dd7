"""Operators of a training-data pipeline, each a general function over DataFrames.

Functions that run in Python workers are pickled by value, so executors need
numpy, pyarrow and the libraries a module imports, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
