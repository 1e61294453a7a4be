"""Readers and writers. Their Python steps travel by value, so executors need the dependencies but not the package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
