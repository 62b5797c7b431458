from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import records
from sluice.operators import merge, route, shape
from sluice.sources.envelope import normalise


def test_quarantine_reasons(spark):
    rows = [
        (None, '{"a":1}', 1),
        ("bad-name!", '{"a":1}', 2),
        ("t", "{bad", 3),
        ("t", "[1,2]", 4),
        ("t", "7", 5),
        ("t", "null", 6),
        ("t", "NaN", 7),
        ("t", "{}", 8),
        ("t", '{"a":1}', 9),
    ]
    prepared = route.prepare(normalise(records(spark, rows)))
    got = {r["kafka_offset"]: r["reason"] for r in prepared.collect()}
    assert got == {
        1: "unroutable",
        2: "invalid_suffix",
        3: "malformed",
        4: "not_object",
        5: "not_object",
        6: "not_object",
        7: "malformed",
        8: None,
        9: None,
    }
    bad = {r["kafka_offset"]: r["raw_value"] for r in route.bad_rows(prepared).collect()}
    assert bad[3] == "{bad" and bad[4] == "[1,2]"
    assert all(r["raw_value"] is None for r in route.good_rows(prepared).collect())


def test_names_of_a_record_are_read_once(spark):
    rows = [("t", '{"a":1,"a":2}', 1), ("t", '{"":1}', 2), ("t", '"x"', 3), ("t", "[{}]", 4), ("t", '{"a":1,"b":2,"c":3}', 5), ("t", None, 6)]
    prepared = route.prepare(normalise(records(spark, rows)), max_fields=2)
    got = {r["kafka_offset"]: r["reason"] for r in prepared.collect()}
    assert got == {1: None, 2: "invalid_field", 3: "not_object", 4: "not_object", 5: "too_many_fields", 6: "malformed"}
    plan = prepared._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(") == 1 and "schemaOfVariant" not in plan


def test_route_suffixes_and_filter(spark):
    rows = [("a", '{"x":1}', 1), ("b", '{"x":1}', 2), ("a", '{"x":1}', 3), (None, '{"x":1}', 4)]
    prepared = route.prepare(normalise(records(spark, rows)))
    assert {(r[0], r[1]) for r in route.route_suffixes(prepared).collect()} == {("a", 2), ("b", 1)}
    assert sorted(r["kafka_offset"] for r in route.route_filter(prepared, "a").collect()) == [1, 3]


def _flat(spark, texts, fields):
    prepared = route.prepare(normalise(records(spark, [("t", t, i) for i, t in enumerate(texts)])))
    return shape.flatten(route.good_rows(prepared), fields)


def test_flatten_casts_and_keeps_json_text(spark):
    fields = [
        shape.FieldPlan("a", "a", "ARRAY<STRING>"),
        shape.FieldPlan("o", "o", "STRING"),
        shape.FieldPlan("n", "n", "DOUBLE"),
        shape.FieldPlan("kafka_ts", "payload_kafka_ts", "BIGINT"),
        shape.FieldPlan("order-id", "order-id", "BIGINT"),
    ]
    row = _flat(spark, ['{"a":[1,"x",{"z":2}],"o":{"a":1},"n":5,"kafka_ts":1,"order-id":9}'], fields).first()
    assert list(row["a"]) == ["1", "x", '{"z":2}']
    assert row["o"] == '{"a":1}' and row["n"] == 5.0 and row["payload_kafka_ts"] == 1 and row["order-id"] == 9


def test_reserved_names_get_prefix():
    reserved = shape.reserved_names()
    assert shape.column_name("kafka_ts", reserved) == "payload_kafka_ts"
    assert shape.column_name("Kafka_Offset", reserved) == "payload_Kafka_Offset"
    assert shape.column_name("amount", reserved) == "amount"


def test_decode_json_with_given_schema(spark):
    df = normalise(records(spark, [("t", '{"a":1,"kafka_ts":3,"b":"x"}', 1)]))
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("kafka_ts", T.LongType())])
    out = shape.decode_json(df, schema)
    assert "value" not in out.columns and "table_suffix" not in out.columns
    row = out.first()
    assert row["a"] == 1 and row["payload_kafka_ts"] == 3


def test_align_and_reorder(spark):
    table = T.StructType(
        [T.StructField("ID", T.LongType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())]
    )
    df = spark.createDataFrame([(1, 2, "n")], "extra long, id long, name string")
    aligned, extra = shape.align_to_schema(df, table)
    assert aligned.columns == ["ID", "name", "x", "extra"] and extra == ["extra"]
    assert aligned.schema["x"].dataType == T.DoubleType() and aligned.first()["x"] is None
    assert shape.reorder_to_schema(df, table).columns == ["id", "name", "extra"]


def test_schema_diff(spark):
    batch = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.LongType())])
    table = T.StructType([T.StructField("ID", T.DoubleType()), T.StructField("amount", T.DoubleType())])
    got = {(r["field"], r["status"]) for r in shape.schema_diff(spark, batch, table).collect()}
    assert got == {("k", "extra"), ("amount", "missing"), ("ID", "type_mismatch")}


def test_dedupe_latest_and_upsert(spark):
    df = spark.createDataFrame(
        [
            (1, 10, 0, 5, "old"),
            (1, 10, 0, 6, "new"),
            (2, 9, 1, 1, "late-ts-wins"),
            (2, 8, 3, 9, "earlier"),
            (None, 1, 0, 1, "n1"),
            (None, 1, 0, 2, "n2"),
        ],
        "unique_id long, kafka_ts long, kafka_partition int, kafka_offset long, v string",
    )
    d = {(r["unique_id"], r["v"]) for r in merge.dedupe_latest(df, "unique_id").collect()}
    assert d == {(1, "new"), (2, "late-ts-wins"), (None, "n1"), (None, "n2")}
    target = spark.createDataFrame([(1, "t1"), (3, "t3"), (None, "tn")], "unique_id long, v string")
    batch = spark.createDataFrame([(1, "b1"), (None, "bn")], "unique_id long, v string")
    got = sorted((r["unique_id"] or -1, r["v"]) for r in merge.upsert_rows(target, batch, "unique_id").collect())
    assert got == [(-1, "bn"), (-1, "tn"), (1, "b1"), (3, "t3")]


def test_upsert_takes_odd_column_names(spark):
    target = spark.createDataFrame([(1, "t"), (2, "u"), (None, "n")], "`a.b` long, `x y` string")
    batch = spark.createDataFrame([(1, "new")], "`a.b` long, `x y` string")
    for broadcast in (False, True):
        keys = merge.key_set(batch, "a.b", broadcast)
        got = {tuple(r) for r in merge.upsert_rows(target, batch, "a.b", keys, broadcast).collect()}
        assert got == {(1, "new"), (2, "u"), (None, "n")}
    assert [tuple(r) for r in merge.touched_values(target, batch, "a.b", "x y").collect()] == [("t",)]


def test_suffix_with_a_final_newline_and_object_after_a_newline(spark):
    rows = [("abc\n", '{"unique_id":1}', 1), ("abc", '\n{"unique_id":1}', 2), ("abc", '{"":1}', 3), ("abc", '{"a\\u0000b":1}', 4)]
    got = {r["kafka_offset"]: r["reason"] for r in route.prepare(normalise(records(spark, rows))).collect()}
    assert got == {1: "invalid_suffix", 2: None, 3: "invalid_field", 4: "invalid_field"}


def test_prefixed_names_do_not_clash():
    reserved = shape.reserved_names()
    fields = ["kafka_ts", "payload_kafka_ts", "payload_payload_kafka_ts", "payload_other", "other"]
    names = [shape.column_name(f, reserved) for f in fields]
    assert len({n.lower() for n in names}) == len(fields)
    assert names[0] == "payload_kafka_ts" and names[3:] == ["payload_other", "other"]


def test_key_bucket_goes_by_the_text_of_the_key(spark):
    df = normalise(records(spark, [("t", "{}", i) for i in range(50)]))
    ints = shape.with_key_bucket(df.withColumn("k", F.col("kafka_offset")), "k", 4)
    wide = shape.with_key_bucket(df.withColumn("k", F.col("kafka_offset").cast("decimal(38,0)")), "k", 4)
    none = shape.with_key_bucket(df.withColumn("k", F.lit(None).cast("long")), "k", 4)
    buckets = lambda d: {r["kafka_offset"]: r["key_bucket"] for r in d.collect()}
    assert buckets(ints) == buckets(wide)
    assert set(buckets(none).values()) == {0, 1, 2, 3}


def test_date_partition_column(spark):
    df = normalise(records(spark, [("t", "{}", 1)]))
    assert shape.with_date_partition(df).select(F.col("kafka_date").cast("string")).first()[0] == "2024-01-01"
