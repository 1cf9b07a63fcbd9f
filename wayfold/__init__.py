"""wayfold: a PySpark-native engine for repeated-observation transit feeds."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions of this package travel to the executors with their code, so that the
# package needs no installation there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
