"""Training-data operators. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors with their code, so that the
# package needs no installation there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
