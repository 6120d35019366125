"""Operators for large training-data pipelines (dedup, decontamination, language ID, mixing ...).

Nothing else in the library imports this subpackage. Its task-side functions are pickled by
value, so executors need numpy, pyarrow and xxhash but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
