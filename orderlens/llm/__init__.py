"""Training-data operators: deduplication, scans, scoring and encoding of text tables.

Nothing else in the library imports this subpackage.  Its functions run inside
Spark's Python workers; they are pickled by value, so executors need no copy of
the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
