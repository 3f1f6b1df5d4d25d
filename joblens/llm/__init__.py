"""Operators for preparing training corpora, one module per operator.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only when it is present.  Functions that run in Python workers are
pickled by value, so executors need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
