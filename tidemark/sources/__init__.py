from .change_stream import kafka_options, read_change_batch, read_change_stream, secure_options
from .feed import change_feed, epoch_millis

__all__ = ["kafka_options", "read_change_batch", "read_change_stream", "secure_options",
           "change_feed", "epoch_millis"]
