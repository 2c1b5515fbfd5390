"""Errors raised by rowtide."""


class SchemaError(ValueError):
    """A table description or header cannot be used."""


class LoadError(RuntimeError):
    """A load broke a table rule; nothing of it was committed."""


class StreamNotReady(TimeoutError):
    """A stream made no progress in the time allowed."""
