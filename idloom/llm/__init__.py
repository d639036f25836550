"""Operators for preparing training data, each a Spark job over ``documents``,
``embeddings`` or ``pages``. Nothing else in the package imports this
subpackage; ``queries.py`` registers one query per operator."""

import sys

from pyspark import cloudpickle

# Task functions are sent to workers by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
