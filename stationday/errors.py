"""Errors raised on the driver; errors found inside tasks surface as Spark runtime errors."""


class DataQualityError(ValueError):
    """A blocking check failed; ``failures`` holds the first failing rows, ``total`` counts them all."""

    def __init__(self, message: str, failures: list | None = None, total: int | None = None):
        super().__init__(message)
        self.failures = failures or []
        self.total = len(self.failures) if total is None else total


class MissingRawObjects(FileNotFoundError):
    """A rebuild was asked for snapshots whose raw objects are not all landed."""


class VerificationError(RuntimeError):
    """What was read back differs from what was written."""
