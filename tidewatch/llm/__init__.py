"""Training-data operators and the corpus pipeline; nothing else in the library imports this package."""
import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value: executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
