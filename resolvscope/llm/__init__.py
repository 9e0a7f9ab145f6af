"""Corpus operators for language-model training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Tasks get the functions themselves, so executors need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
