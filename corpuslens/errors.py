"""Exceptions raised before a job is submitted."""


class DataContractError(ValueError):
    """A table does not satisfy the column or label contract."""


class ModelNotReadyError(RuntimeError):
    """Stored model tables are missing or unreadable."""
