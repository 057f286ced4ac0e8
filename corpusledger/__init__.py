"""corpusledger: token-budgeted corpus selection, accounting and audit on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run inside Python workers travel with the job, so the package does not have
# to be installed on every executor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
