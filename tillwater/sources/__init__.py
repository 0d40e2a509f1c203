"""Readers for topics, folders, config, dimension and serving tables."""

from tillwater.sources.streams import (
    file_stream,
    json_stream,
    kafka_stream,
    literal_records,
    with_event_time,
)
from tillwater.sources.tables import (
    jdbc_table,
    read_dim,
    read_route_feed,
    read_routes,
    read_serving,
)

__all__ = [
    "file_stream", "jdbc_table", "json_stream", "kafka_stream", "literal_records",
    "read_dim", "read_route_feed", "read_routes", "read_serving", "with_event_time",
]
