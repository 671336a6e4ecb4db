"""Training-data operators: one module per operator, their queries and oracle SQL.

Nothing else in the library imports this subpackage. ``queries.QUERIES`` and
``oracle.SQL`` are merged into the driver entry only when it can be imported.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a cluster needs the
# package on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
