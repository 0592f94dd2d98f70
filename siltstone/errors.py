"""Exceptions of the table layer."""


class SiltstoneError(Exception):
    pass


class TableNotFound(SiltstoneError, FileNotFoundError):
    """No table at the location, or no such version."""


class CommitConflict(SiltstoneError):
    """Another writer's commit can't be reconciled with this one."""


class UnsupportedType(SiltstoneError, TypeError):
    """A type that can't be stored without changing it."""
