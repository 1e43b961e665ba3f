"""PEP 249 exceptions and how failures of Spark become them."""

from __future__ import annotations


class Warning(Exception):  # noqa: A001, N818  the name is PEP 249's
    pass


class Error(Exception):
    pass


class InterfaceError(Error):
    pass


class DatabaseError(Error):
    pass


class DataError(DatabaseError):
    pass


class OperationalError(DatabaseError):
    pass


class IntegrityError(DatabaseError):
    pass


class InternalError(DatabaseError):
    pass


class ProgrammingError(DatabaseError):
    pass


class NotSupportedError(DatabaseError):
    pass


class SqlParseError(ProgrammingError):
    """The text is no statement of the dialect."""


class SqlSemanticError(ProgrammingError):
    """Names, types or rules of the dialect don't fit."""


class BackendOperationError(OperationalError):
    """A table store refused an operation."""


class CapabilityError(NotSupportedError):
    """The table store can't do this at all."""


def mapped(error: Exception) -> Error:
    """The PEP 249 exception for what a Spark action raised."""
    if isinstance(error, Error):
        return error
    condition = getattr(error, "getCondition", lambda: None)() or ""
    text = str(error)
    if "DIVIDE_BY_ZERO" in condition + text or "CAST_INVALID_INPUT" in condition + text or "USER_RAISED_EXCEPTION" in condition + text:
        return ProgrammingError(text.split("\n")[0])
    if "SCALAR_SUBQUERY_TOO_MANY_ROWS" in condition + text:
        return ProgrammingError("Scalar subquery returned more than one row")
    if isinstance(error, FileNotFoundError | PermissionError | IsADirectoryError):
        return OperationalError(text)
    if isinstance(error, TypeError | ValueError):
        return ProgrammingError(text)
    return DatabaseError(text.split("\n")[0])
