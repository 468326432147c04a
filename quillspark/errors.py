"""Errors raised on the driver, before any job runs."""


class MappingError(ValueError):
    """A bad field definition, or a field the mapping does not have."""


class QueryError(ValueError):
    """A query that cannot be asked of this index."""


class AggregationError(ValueError):
    """An aggregation over a field that does not support it."""


class CommitConflict(RuntimeError):
    """Another writer has committed this version."""
