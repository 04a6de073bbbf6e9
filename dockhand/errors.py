"""Errors a load can raise."""


class LoadError(Exception):
    """Base class of every error raised by this package."""


class SpecError(LoadError):
    """The load description is incomplete or holds a value that is not allowed."""


class ConflictError(LoadError):
    """A ``nonconflict`` load found files of its own group in the target."""


class CommitError(LoadError):
    """Staged files could not be put in place, or the target is not usable."""


class RejectLimitError(CommitError):
    """More rows were rejected than the load description allows; the target is as it was."""
