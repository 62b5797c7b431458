from __future__ import annotations

import datetime as dt
import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sluice import MultiTableSink, SinkConfig  # noqa: E402
from sluice.session import local_session, scratch_path  # noqa: E402
from sluice.sources.envelope import RAW_ENVELOPE  # noqa: E402

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
BATCH_TIME = dt.datetime(2024, 6, 1)


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=8)


def records(spark, rows):
    """Raw envelope frame from (suffix | None, json text, offset[, seconds after T0[, partition]]) tuples.

    A suffix of ``None`` gives a record without headers.
    """
    out = []
    for r in rows:
        suffix, text, offset = r[0], r[1], r[2]
        seconds = r[3] if len(r) > 3 else offset
        partition = r[4] if len(r) > 4 else 0
        headers = None if suffix is None else [("table_suffix", bytearray(suffix, "utf-8"))]
        out.append(
            (
                bytearray(f"key{offset}", "utf-8"),
                None if text is None else bytearray(text, "utf-8"),
                "topic",
                partition,
                offset,
                T0 + dt.timedelta(seconds=seconds),
                0,
                headers,
            )
        )
    return spark.createDataFrame(out, RAW_ENVELOPE)


def new_sink(spark, **config) -> MultiTableSink:
    label = uuid.uuid4().hex[:10]
    config.setdefault("key_buckets", 4)
    return MultiTableSink(
        spark, SinkConfig(database=f"t_{label}", root=scratch_path(spark, f"test-{label}"), **config)
    )
