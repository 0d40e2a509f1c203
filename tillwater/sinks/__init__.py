"""Writers. Stream sinks take a DataFrame and return a writer to start."""

from tillwater.sinks.once import once_sink, read_once
from tillwater.sinks.streams import (
    console_sink,
    file_sink,
    kafka_sink,
    landing_sink,
    memory_sink,
    routed_file_sink,
    routed_kafka_sink,
    serving_sink,
)
from tillwater.sinks.tables import (
    compact_dim,
    enriching_sink,
    fact_folders,
    fact_topics,
    hidden,
    jdbc_sink,
    routing_sink,
    visible,
    write_dims,
)
from tillwater.sinks.updates import read_updated, updating_sink

__all__ = [
    "compact_dim", "console_sink", "enriching_sink", "fact_folders", "fact_topics",
    "file_sink", "hidden", "jdbc_sink", "kafka_sink", "landing_sink", "memory_sink",
    "once_sink", "read_once", "read_updated", "routed_file_sink", "routed_kafka_sink", "routing_sink", "serving_sink",
    "updating_sink", "visible", "write_dims",
]
