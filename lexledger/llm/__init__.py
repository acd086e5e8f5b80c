"""Training-data operators: deduplication, scoring, extraction, mixing and packing.

Functions of this package are shipped to executors by value, so that a cluster
needs no copy of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
