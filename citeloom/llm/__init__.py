"""Operators for large training-data pipelines, one module each.

Functions that run in tasks travel with their code, so executors need no copy of
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
