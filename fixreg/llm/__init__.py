"""Operators for training-data pipelines: scans, tokens, dedup, search, chat logs.

Tasks carry the code they run (pickled by value), so executors need no copy of
the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
