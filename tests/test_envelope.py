from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import records
from sluice.session import scratch_path
from sluice.sources import envelope


def test_normalise_renames_and_routes(spark):
    n = envelope.normalise(records(spark, [("sensor_data", '{"a":1}', 7)]))
    assert n.columns == [
        "kafka_key",
        "value",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_ts",
        "kafka_ts_type",
        "table_suffix",
    ]
    row = n.first()
    assert row["table_suffix"] == "sensor_data"
    assert bytes(row["kafka_key"]) == b"key7"
    assert row["kafka_offset"] == 7


def test_missing_or_empty_headers_give_null_suffix(spark):
    df = records(spark, [(None, '{"a":1}', 1)]).unionByName(
        records(spark, [("x", '{"a":1}', 2)]).withColumn("headers", F.array().cast(envelope.RAW_ENVELOPE["headers"].dataType))
    )
    got = [r["table_suffix"] for r in envelope.normalise(df).collect()]
    assert got == [None, None]


def test_payload_text_casts_binary(spark):
    t = envelope.payload_text(envelope.normalise(records(spark, [("a", '{"x":"töpfer"}', 1)])))
    assert t.first()["value"] == '{"x":"töpfer"}'


def test_kafka_options_validate_and_shape():
    with pytest.raises(ValueError, match="bootstrap_servers"):
        envelope.kafka_options(topic="t")
    batch = envelope.kafka_options(bootstrap_servers="h:9092", topic="t")
    assert batch["includeHeaders"] == "true"
    assert batch["startingOffsets"] == "earliest" and batch["endingOffsets"] == "latest"
    stream = envelope.kafka_options(bootstrap_servers="h:9092", topic="t", streaming=True)
    assert "endingOffsets" not in stream


def test_kafka_encode_projection(spark):
    enc = envelope.kafka_encode(records(spark, [("a", '{"x":1}', 3)]))
    row = enc.first()
    assert enc.columns == ["key", "value", "headers"]
    assert row["key"] == "key3" and row["value"] == '{"x":1}'


def test_json_roundtrip_keeps_binary_and_microseconds(spark):
    src = records(spark, [("a", '{"x":1}', 3, 1.234567)])
    path = scratch_path(spark, "json-test") + "/r"
    envelope.write_json(src, path)
    back = envelope.read_json(spark, path)
    a, b = src.first(), back.first()
    assert bytes(b["value"]) == bytes(a["value"]) and b["timestamp"] == a["timestamp"]
    assert bytes(b["headers"][0]["value"]) == b"a"


def test_kafka_reader_asks_for_split_partitions(spark):
    from sluice.sources.envelope import _with_min_partitions

    opts = envelope.kafka_options(streaming=True, **_with_min_partitions(spark, {"bootstrap_servers": "h", "topic": "t"}))
    assert int(opts["minPartitions"]) == spark.sparkContext.defaultParallelism
    keep = _with_min_partitions(spark, {"minPartitions": "3"})
    assert keep["minPartitions"] == "3"
