"""What a user can set, read from environment variables with defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


def _text(name: str, default: str):
    return field(default_factory=lambda: os.environ.get(name, default))


def _number(name: str, default, kind=int):
    return field(default_factory=lambda: kind(os.environ.get(name, default)))


# Default topic and consumer-group names, limits and intervals.
@dataclass(frozen=True)
class Settings:
    bootstrap_servers: str = _text("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
    topic: str = _text("KAFKA_TOPIC", "ecommerce-events")
    dlq_topic: str = _text("KAFKA_DLQ_TOPIC", "ecommerce-events-dlq")
    retry_topic: str = _text("KAFKA_RETRY_TOPIC", "ecommerce-events-retry")
    consumer_group: str = _text("KAFKA_CONSUMER_GROUP", "ingestion-service")
    retry_consumer_group: str = _text("KAFKA_RETRY_CONSUMER_GROUP", "retry-service")
    # Offsets advance once per micro-batch, so this is both the batch and the commit size.
    max_per_batch: int = _number("COMMIT_BATCH_SIZE", 5_000_000)
    batch_interval_seconds: float = _number("COMMIT_INTERVAL_SECONDS", 2.0, float)
    write_attempts: int = _number("DB_RETRY_ATTEMPTS", 5)
    write_backoff_seconds: float = _number("DB_RETRY_BACKOFF_SECONDS", 2.0, float)
    retry_max_attempts: int = _number("RETRY_MAX_ATTEMPTS", 3)
    db_host: str = _text("POSTGRES_HOST", "localhost")
    db_port: int = _number("POSTGRES_PORT", 5432)
    db_name: str = _text("POSTGRES_DB", "ecommerce")
    db_user: str = _text("POSTGRES_USER", "ecommerce")
    db_password: str = _text("POSTGRES_PASSWORD", "ecommerce")
