from presswork.sources.files import read_articles_files, read_wire_files
from presswork.sources.kafka import read_articles_kafka

__all__ = ["read_articles_files", "read_articles_kafka", "read_wire_files"]
