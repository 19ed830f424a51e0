"""Operators for preparing language-model training data.

Every operator takes DataFrames and returns a DataFrame; `entry.py` applies
each to its whole table. Nothing outside this folder (but the optional hook in
the entry point and `corpus_pipeline.py`) imports it.

Functions that run inside Python workers are shipped by value, so executors
need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
