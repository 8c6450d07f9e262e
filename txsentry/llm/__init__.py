"""Operators for large text corpora (training-data preparation).

One module per operator; ``queries`` registers them. Nothing outside this
subpackage imports it except the driver entry, and only when it is there.

Functions of this subpackage that run in tasks are sent to the executors by value, so a
cluster needs no copy of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
