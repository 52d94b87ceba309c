"""Operators for preparing training data at scale, one module each; ``queries`` applies them to the given tables."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors with the task, which need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
