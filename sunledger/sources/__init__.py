from sunledger.sources.decode import decode_json, decode_with_rejects
from sunledger.sources.files import csv_readings, csv_with_rejects, message_files
from sunledger.sources.kafka import kafka_messages, kafka_options

__all__ = [
    "csv_readings",
    "csv_with_rejects",
    "decode_json",
    "decode_with_rejects",
    "kafka_messages",
    "kafka_options",
    "message_files",
]
