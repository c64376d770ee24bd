"""Operators for training-data pipelines. Nothing outside this package (and corpus_pipeline.py) imports it.

Task functions travel by value, so executors need the third-party packages but no copy of this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
