"""Operators of a training-data pipeline over documents, pages and benchmark items.

Nothing else in the package imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` derives the registered
``opN_<name>`` queries from them.

The functions that run in Python workers travel with the job (pickled by
value), so executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
