"""Operators for preparing training text: filtering, deduplication, extraction, search, mixing, archives.

Nothing else in the library imports this package. Its Python steps travel by value, so executors
need the package's dependencies (numpy, pyarrow) but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
