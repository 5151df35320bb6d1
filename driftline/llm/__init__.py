"""Training-data operators: scoring, mixing, dedup, packing, extraction and search.

Nothing else in the library imports this package. Its functions are pickled by value, so
executors need only the public dependencies installed, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
