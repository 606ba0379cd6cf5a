"""Operators for preparing text corpora for language-model training.

Nothing outside this package imports it; its queries join the registry only if it is there.
Functions that run in Python workers are shipped with the job by value, so executors need no
copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
