"""Reusable table and stream operators on the public PySpark API.

Every operator is a plain function from DataFrames (and parameters) to a
DataFrame.  No operator creates a session, changes a session setting or pulls
a data set to the driver.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code with them, so the workers need
# not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
