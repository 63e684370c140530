"""Training-data operators: mixing, filtering, deduplication, search, scanning, encoding, extraction."""

import sys

from pyspark import cloudpickle

# functions that run on executors travel with their code: executors need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
