"""Exceptions raised on the driver while a plan is being built or an input is refused."""


class IntakeError(Exception):
    """Base class of every error of this package."""


class DecodeError(IntakeError):
    """An input file or format cannot be read."""


class TransformFailure(IntakeError):
    """A transform does not fit the schema of the frame it is applied to."""


class UnificationError(IntakeError):
    """Two schemas cannot be brought together without losing information."""


class StateConflictError(IntakeError):
    """A state snapshot was replaced by another writer in the meantime."""
