"""Full-text search and search analytics over Spark tables."""

from quillspark.errors import AggregationError, MappingError, QueryError
from quillspark.mapping import Field, Mapping
from quillspark.operators.aggs import aggregate
from quillspark.operators.batch import batch_search
from quillspark.operators.search import (
    browse,
    count_hits,
    highlight_all,
    lookup,
    search,
    search_indexes,
    top_k,
)
from quillspark.sources.index import Index
from quillspark.sources.versions import IndexDirectory, build_index
from quillspark.streaming.ingest import index_stream

__all__ = [
    "AggregationError", "Field", "Index", "IndexDirectory", "Mapping", "MappingError", "QueryError", "aggregate",
    "batch_search", "browse", "build_index", "count_hits", "highlight_all", "index_stream", "lookup", "search",
    "search_indexes", "top_k",
]
