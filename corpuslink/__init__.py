"""Corpus search, document media extraction and record linkage on Spark tables."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors with their code, so the package
# itself need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
