"""Failures a job can end with; all are ValueErrors."""


class InvalidInput(ValueError):
    """A record, manifest or parameter breaks the input contract."""


class DuplicateDocuments(InvalidInput):
    """Two documents carry the same ID."""


class IntegrityError(ValueError):
    """Stored data no longer matches what its receipt says."""


class BindingMismatch(IntegrityError):
    """The output was made with other settings."""
