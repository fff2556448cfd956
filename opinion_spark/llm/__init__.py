"""Training-data operators: each module is one operator with its own interface.

Worker functions are pickled by value, so executors need only the public
Python packages the operators use, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
