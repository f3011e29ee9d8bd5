from __future__ import annotations

import pytest

from tillstream.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(folder / "warehouse"),
        "spark.checkpoint.dir": str(folder / "checkpoints"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def messages(spark):
    """Builds topic rows from payloads (dicts or text) or (key, payload) pairs."""
    import json

    from tillstream.schemas import MESSAGE_SCHEMA

    def build(payloads, topic="shop", partition=0, first_offset=0):
        rows = []
        for i, payload in enumerate(payloads):
            if isinstance(payload, dict):
                payload = json.dumps(payload)
            value = payload.encode() if isinstance(payload, str) else payload
            rows.append((b"user_1", value, topic, partition, first_offset + i, None))
        return spark.createDataFrame(rows, MESSAGE_SCHEMA)

    return build


@pytest.fixture
def event():
    """A good purchase with some fields changed; None values stay, DROP removes a key."""
    def build(**changes):
        base = {"event_id": "e1", "event_type": "PURCHASE", "timestamp": "2024-01-15T10:00:00Z",
                "user_id": "user_1", "product_id": "prod_1", "quantity": 2, "unit_price": 19.99}
        return {k: v for k, v in {**base, **changes}.items() if v != "DROP"}

    return build
