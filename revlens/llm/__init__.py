"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it. Task functions are shipped by value, so
executors need numpy, pyarrow and the tokenizer files, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
