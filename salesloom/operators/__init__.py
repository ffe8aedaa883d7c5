"""DataFrame -> DataFrame building blocks of the warehouse.

Functions of this package that run inside tasks travel to the executors by value, as
those of ``salesloom.llm``: a cluster needs no copy of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
