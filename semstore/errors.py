"""Exceptions raised while a plan is built or a collection is changed."""


class SemstoreError(Exception):
    """Base class of every error raised here."""


class RecordError(SemstoreError, ValueError):
    """A record, an id list, a collection or a call argument is not acceptable."""


class EmbeddingError(SemstoreError, ValueError):
    """A text or a vector cannot be used for embedding."""


class ConflictError(SemstoreError, RuntimeError):
    """Other writers committed again and again while a change was being made."""


class FilterError(SemstoreError, ValueError):
    """A payload filter is malformed."""

    def __init__(self, message: str, kind: str | None = None, key: str | None = None):
        super().__init__(message)
        self.kind = kind
        self.key = key
