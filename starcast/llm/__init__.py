"""Training-data operators (dedup, filtering, mixing, packing, search).

Nothing else in the library imports this package. Executor-side code is
shipped by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
