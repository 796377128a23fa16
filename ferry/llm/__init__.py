"""Operators for preparing language-model training data.

Nothing outside this package imports it. Helpers used inside tasks are pickled
by value, so executors need no installed copy of the package.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
