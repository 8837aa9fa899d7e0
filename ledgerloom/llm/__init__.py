"""Training-data operators: filtering, language, quality, fingerprints, duplicates, extraction, packing, search.

Functions that run in Python workers travel by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
