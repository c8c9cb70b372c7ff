from .events import (file_source, idempotent_batch_writer, kafka_source, parse_messages, read_sink,
                     start)

__all__ = ["file_source", "idempotent_batch_writer", "kafka_source", "parse_messages", "read_sink",
           "start"]
