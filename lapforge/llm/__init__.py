"""Training-data operators: packing, line and exact de-duplication, n-gram join,
WARC salvage, toxicity, secrets, decontamination, quality and language ID.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers are shipped by value, so executors need numpy, pyarrow and the
tokenizer library but not this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
