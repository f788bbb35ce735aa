"""Operators for preparing language-model training data, and their queries.

Nothing else in the library imports this package.  The Python functions that
its tasks run are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
