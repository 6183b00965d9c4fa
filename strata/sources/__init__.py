"""Sources and sinks."""

from strata.sources.readers import (
    TRIP_SCHEMA,
    corpus_size,
    parse_category_links,
    parse_doc_lines,
    read_category_links,
    read_doc_lines,
    read_lines,
    read_trips,
)
from strata.sources.sinks import write_result

__all__ = [
    "TRIP_SCHEMA",
    "read_trips",
    "read_lines",
    "read_doc_lines",
    "parse_doc_lines",
    "read_category_links",
    "parse_category_links",
    "corpus_size",
    "write_result",
]
