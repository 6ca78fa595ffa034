"""Exceptions that callers can tell apart."""


class TidewellError(Exception):
    """Base of all errors that this library raises on purpose."""


class ConfigurationError(TidewellError):
    """A setting is missing or out of bounds."""


class BatchError(TidewellError, ValueError):
    """A landed batch is damaged, inconsistent or in conflict with another."""


class QualityError(TidewellError, ValueError):
    """A table breaks a precondition or doesn't reconcile."""


class StoreError(TidewellError):
    """A table can't be published."""
