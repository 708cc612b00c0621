"""Training-data operators: each module holds one operator, ``queries`` registers them.

Functions of this subpackage run inside Spark tasks; they are pickled by value so that
executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
