"""PySpark-native engine for preparing and evaluating language-model training data.

Functions of this package that run on executors travel by value, so that executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
