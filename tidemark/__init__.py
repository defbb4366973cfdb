"""tidemark: ordered, low-water-mark gated replay of partitioned message logs
on Spark DataFrames."""

from .schema import (MESSAGE_SCHEMA, PARTITION_STATE_SCHEMA, get_message_schema,
                     get_partition_state_schema)
from .sources.topics import SourceTopic, validate_source_topic, validate_topics

__version__ = "0.1.0"

__all__ = [
    "__version__",
    "MESSAGE_SCHEMA",
    "PARTITION_STATE_SCHEMA",
    "SourceTopic",
    "get_message_schema",
    "get_partition_state_schema",
    "validate_source_topic",
    "validate_topics",
]
