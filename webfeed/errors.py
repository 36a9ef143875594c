"""Exceptions raised by feed reads. All derive from :class:`FeedError`."""


class FeedError(ValueError):
    """Base class for every problem with a feed read."""


class FeedOptionError(FeedError):
    """Invalid or conflicting read options (date selection, lookup name, ...)."""


class DeliveryError(FeedError):
    """Deliveries are missing or incomplete (no manifest, gap, missing archive)."""


class ManifestError(FeedError):
    """A manifest cannot be parsed or contradicts itself."""


class SchemaMismatchError(FeedError):
    """Selected deliveries do not share one set of columns."""


class ValidationError(FeedError):
    """``validate=True`` found a file whose digest, size or row count is wrong."""

    def __init__(self, message: str, failures: list | None = None):
        super().__init__(message)
        self.failures = failures or []
