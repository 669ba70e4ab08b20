from clickmill.sources.catalog import TEXT_SPLITS, dataset_paths, read_dataset
from clickmill.sources.clicks import (
    Ingested,
    ingest_log,
    mark_rejects,
    parse_lines,
    read_clicks,
    read_lines,
    to_lines,
    validate_log,
    write_clicks,
    write_lines,
)

__all__ = [
    "Ingested",
    "TEXT_SPLITS",
    "dataset_paths",
    "ingest_log",
    "mark_rejects",
    "parse_lines",
    "read_clicks",
    "read_dataset",
    "read_lines",
    "to_lines",
    "validate_log",
    "write_clicks",
    "write_lines",
]
