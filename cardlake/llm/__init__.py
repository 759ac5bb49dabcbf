"""Training-data operators: ten corpus operators and the queries that apply them.

Nothing outside this package imports it.  Its functions run in executor
Python workers, which need not have the package installed: they are shipped
with the task (by value).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
