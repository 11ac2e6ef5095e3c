"""Operators for preparing training corpora.

Functions of this package that run inside tasks travel with the job by value, so
executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
