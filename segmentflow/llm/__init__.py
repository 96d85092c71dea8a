"""Training-data operators: one module per operator, the registered queries
in ``queries``.  Nothing else in the library imports this subpackage.

The task functions are sent to the executors by value, so a cluster needs
no copy of this package on its machines.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
