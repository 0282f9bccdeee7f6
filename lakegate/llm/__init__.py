"""Operators for training-data pipelines: tables of documents in, tables out.

Functions of this package that run on executors travel with the task by value, so executors need numpy, pyarrow and
the tokenizer libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
