"""lakegate: open-data intake, publication and catalog bookkeeping on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from lakegate.errors import (
    DecodeError,
    IntakeError,
    StateConflictError,
    TransformFailure,
    UnificationError,
)

__all__ = ["DecodeError", "IntakeError", "StateConflictError", "TransformFailure", "UnificationError"]

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
