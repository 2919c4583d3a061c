"""Training-data operators: extraction, search, token counts, language, dedup, filters, packing.

Nothing outside this folder imports it. Its task functions are shipped to
executors by value, so a cluster needs no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
