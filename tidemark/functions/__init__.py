"""Scalar column helpers (all JVM-side built-ins)."""

from ..operators.offsets import start_of_day_target
from ..schema import decode_value, ms_to_timestamp, timestamp_to_ms
from ..sources.log import arrival_epoch, epoch_ms

__all__ = ["arrival_epoch", "decode_value", "epoch_ms", "ms_to_timestamp", "start_of_day_target",
           "timestamp_to_ms"]
