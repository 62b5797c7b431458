"""Plan shape: the properties that matter at scale, read from explain()."""

from __future__ import annotations

import contextlib
import io
import json

from pyspark.sql import functions as F

from tests.conftest import BATCH_TIME, new_sink, records
from sluice.operators import infer, merge, route
from sluice.sources.envelope import normalise

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _prepared(spark, n=300, hot_share=3):
    rows = []
    for i in range(n):
        key = 0 if i % hot_share == 0 else i  # one key holds a third of the rows
        rows.append(("t" if i % 2 else "u", json.dumps({"unique_id": key, "v": i}), i))
    return route.prepare(normalise(records(spark, rows)))


def test_inference_combines_map_side_and_stays_in_jvm(spark):
    text = plan_text(infer.infer_schema(infer.observe_fields(_prepared(spark))))
    assert "partial_count" in text
    assert not any(n in text for n in PYTHON_NODES)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    prepared = _prepared(spark)
    rows = prepared.select(
        "kafka_ts", "kafka_partition", "kafka_offset",
        F.variant_get("payload", "$.unique_id", "bigint").alias("unique_id"),
        F.variant_get("payload", "$.v", "bigint").alias("v"),
    )
    deduped = merge.dedupe_latest(rows, "unique_id")
    text = plan_text(deduped)
    assert "partial_max_by" in text
    got = {r["unique_id"]: r["v"] for r in deduped.collect()}
    assert got[0] == 297  # latest of the hot key (offsets 0, 3, ..., 297)
    assert len(got) == 201


def test_probe_reads_only_the_key_of_the_batch_buckets(spark):
    sink = new_sink(spark)
    sink.process_batch(records(spark, [("t", json.dumps({"unique_id": i, "a": i}), i) for i in range(50)]), 0, "w", BATCH_TIME)
    target = spark.table(sink.table("t"))
    probe = target.where(F.col("key_bucket").isin([1, 3]))
    text = plan_text(merge.touched_values(probe, target.where("a > 5"), "unique_id", ["kafka_date", "key_bucket"]))
    scans = [line for line in text.splitlines() if "PartitionFilters" in line]
    assert any("key_bucket" in s and "IN (1,3)" in s for s in scans)
    assert "ReadSchema: struct<unique_id:bigint>" in text


def test_update_rewrites_only_the_buckets_that_hold_its_keys(spark):
    sink = new_sink(spark, key_buckets=8)
    first = [("t", json.dumps({"unique_id": i, "v": i}), i, 86_400 * (i % 3)) for i in range(60)]
    sink.process_batch(records(spark, first), 0, "w", BATCH_TIME)
    key = "kafka_date, key_bucket"
    where = {r["unique_id"]: (str(r["kafka_date"]), r["key_bucket"]) for r in spark.table(sink.table("t")).collect()}
    # An update of one key on its day, and of one that moves to another day.
    update = [("t", json.dumps({"unique_id": 7, "v": -7}), 100, 86_400), ("t", json.dumps({"unique_id": 9, "v": -9}), 101, 86_400)]
    sink.process_batch(records(spark, update), 1, "w", BATCH_TIME)
    after = spark.table(sink.table("t"))
    rewritten = {(str(r[0]), r[1]) for r in after.where("ingest_batch like 'w-000000000001-%'").select(*key.split(", ")).distinct().collect()}
    assert rewritten == {where[7], where[9], (where[7][0], where[9][1])}
    got = {r["unique_id"]: r["v"] for r in after.collect()}
    assert got == {i: -i if i in (7, 9) else i for i in range(60)}
    versions = after.select("kafka_date", "key_bucket", "ingest_batch").distinct().count()
    assert versions == after.select("kafka_date", "key_bucket").distinct().count()


def test_one_scan_of_the_target_where_the_keys_are_broadcast(spark):
    sink = new_sink(spark)
    sink.process_batch(records(spark, [("t", json.dumps({"unique_id": i}), i) for i in range(20)]), 0, "w", BATCH_TIME)
    target = sink.read("t")
    batch = spark.createDataFrame([(1,)], "unique_id long")
    rows = target.select("unique_id")
    text = plan_text(merge.upsert_rows(rows, batch, "unique_id", merge.key_set(batch, "unique_id", True), True))
    assert text.count("Scan parquet") == 2  # heading and detail of one scan
    assert "BroadcastHashJoin LeftAnti" in text or "LeftAnti BuildRight" in text


def test_null_keys_skip_the_join(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "unique_id long, v string")
    batch = spark.createDataFrame([(1, "c")], "unique_id long, v string")
    text = plan_text(merge.upsert_rows(target, batch, "unique_id"))
    # The anti join only sees rows filtered to non-NULL keys.
    assert "isnotnull(unique_id" in text and "LeftAnti" in text


def test_registered_flatten_has_no_python(spark):
    from sluice.operators import shape

    prepared = _prepared(spark)
    flat = shape.flatten(route.route_filter(prepared, "t"), [shape.FieldPlan("v", "v", "BIGINT")])
    assert not any(n in plan_text(flat) for n in PYTHON_NODES)


def test_key_set_is_hash_combined_and_broadcast_only_when_asked(spark):
    target = spark.createDataFrame([(i, "a") for i in range(20)], "unique_id long, v string")
    batch = spark.createDataFrame([(1, "c"), (1, "d"), (None, "e")], "unique_id long, v string")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = plan_text(merge.upsert_rows(target, batch, "unique_id", merge.key_set(batch, "unique_id")))
        hinted = plan_text(
            merge.upsert_rows(target, batch, "unique_id", merge.key_set(batch, "unique_id", broadcast=True), True)
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "SortMergeJoin LeftAnti" in shuffled and "BroadcastHashJoin" not in shuffled
    assert "BroadcastHashJoin LeftAnti" in hinted
    # Keys to be shuffled are combined map-side by a hash aggregate, never sorted as whole rows.
    assert "HashAggregate" in shuffled and "Exchange hashpartitioning" not in hinted


def test_sink_broadcasts_the_key_set_only_under_its_limit(spark):
    from sluice.plans import batch as batch_plan

    seen = []
    original = batch_plan.key_set

    def spy(df, key, broadcast=False):
        seen.append(broadcast)
        return original(df, key, broadcast)

    batch_plan.key_set = spy
    try:
        for limit, expected in ((1 << 20, True), (100, False)):
            sink = new_sink(spark, broadcast_keys_max_bytes=limit)
            first = [("t", json.dumps({"unique_id": i, "a": i}), i) for i in range(50)]
            sink.process_batch(records(spark, first), 0, "w", BATCH_TIME)
            update = [("t", json.dumps({"unique_id": i, "a": -i}), 100 + i) for i in range(0, 50, 5)]
            sink.process_batch(records(spark, update), 1, "w", BATCH_TIME)
            assert seen[-1] is expected
            got = dict(sink.read("t").select("unique_id", "a").collect())
            assert len(got) == 50 and got[5] == -5 and got[6] == 6
    finally:
        batch_plan.key_set = original


def test_byte_size_reads_spark_size_settings():
    from sluice.session import byte_size

    assert byte_size("10485760b") == 10485760
    assert byte_size("20m") == 20 << 20
    assert byte_size("1GB") == 1 << 30
    assert byte_size("-1") == -1


def test_spread_hashes_on_record_identity_and_evens_a_hot_partition(spark):
    from pyspark.sql import functions as F

    # One Kafka partition holds a third of the records, all in one input partition.
    rows = [("t", json.dumps({"unique_id": i}), i, i, 0 if i % 3 == 0 else 1 + i % 5) for i in range(600)]
    batch = normalise(records(spark, rows)).coalesce(1)
    spread = route.spread(batch, 8)
    text = plan_text(spread)
    assert "hashpartitioning(kafka_topic" in text and "kafka_offset" in text
    assert "RoundRobinPartitioning" not in text
    sizes = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * 600 / 8
    # Not asked for: left as it is.
    assert route.spread(batch) is batch and route.spread(batch, 0) is batch


def scan_rows(df) -> int:
    """Rows that the file scans of an executed plan have returned."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name.startswith("Scan parquet"):
            total += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_a_small_batch_reads_few_row_groups_of_the_key_column(spark):
    hadoop = spark._jsc.hadoopConfiguration()
    kept = hadoop.get("parquet.block.size")
    hadoop.set("parquet.block.size", str(16 << 10))
    hadoop.set("parquet.page.row.count.limit", "500")
    try:
        sink = new_sink(spark, key_buckets=1)
        n = 40_000
        # Wide random keys, several batches: ranges of keys say little about a file's row groups.
        ids = spark.range(n).selectExpr("id", "abs(xxhash64(id)) AS k")
        for b in range(2):
            rows = ids.where(f"id % 2 = {b}").selectExpr(
                "cast('x' AS binary) AS key",
                "cast(concat('{\"unique_id\":', k, '}') AS binary) AS value",
                "'topic' AS topic",
                "0 AS partition",
                "id AS offset",
                f"timestamp '2024-01-0{b + 1} 00:00:00' AS timestamp",
                "0 AS timestampType",
                "array(named_struct('key', 'table_suffix', 'value', cast('t' AS binary))) AS headers",
            )
            sink.process_batch(rows.coalesce(2), b, "w", BATCH_TIME)
        keys = [r["k"] for r in ids.where("id < 10").collect()]
        target = spark.table(sink.table("t"))
        found = target.where(F.col("unique_id").isin(keys)).select("kafka_date", "key_bucket").distinct()
        read = scan_rows(found)
        assert len(found.collect()) == 2 and read < n / 5, read
        # The sink looks for keys in this way.
        batch = spark.createDataFrame([(k,) for k in keys], "unique_id long")
        assert len(sink._probe(target, batch, "unique_id", merge.key_set(batch, "unique_id"), 10)) == 2
        assert len(sink._probe(target, batch, "unique_id", merge.key_set(batch, "unique_id"), 10**6)) == 2
    finally:
        hadoop.unset("parquet.page.row.count.limit")
        hadoop.set("parquet.block.size", kept) if kept else hadoop.unset("parquet.block.size")


def test_the_days_asked_for_are_a_partition_filter(spark):
    sink = new_sink(spark, match_days=2)
    rows = [("t", json.dumps({"unique_id": i}), i, 86_400 * i) for i in range(9)]
    sink.process_batch(records(spark, rows), 0, "w", BATCH_TIME)
    text = plan_text(sink._in_reach(spark.table(sink.table("t")), ["2024-01-05"]).select("unique_id"))
    scans = [line for line in text.splitlines() if "PartitionFilters" in line]
    assert any("kafka_date" in s and "2024-01-03" in s and "2024-01-07" in s for s in scans)


def test_counts_come_from_the_footers(spark):
    from sluice.plans import counts

    sink = new_sink(spark, key_buckets=2)
    rows = [("t", json.dumps({"unique_id": i, "a b": i if i % 3 else None, "c": "x" * (i % 2)}), i, 86_400 * (i % 2)) for i in range(30)]
    sink.process_batch(records(spark, rows), 0, "w", BATCH_TIME)
    sink.process_batch(records(spark, [("t", '{"unique_id":3}', 90), ("t", '{"unique_id":99,"d":true}', 91)]), 1, "w", BATCH_TIME)
    table = sink.read("t")
    columns = ["unique_id", "a b", "c", "d"]
    want = table.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns]).first().asDict()
    assert {r["field"]: r["n"] for r in counts.not_null_counts(table, columns).collect()} == want
    schema = table.select("unique_id", "c").schema
    text = plan_text(counts.footer_counts(spark, table.inputFiles(), schema, ["c"]))
    assert "PushedAggregation: [COUNT(" in text
    # Settings are as before, and a table without files has no rows.
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    assert counts.not_null_counts(spark.createDataFrame([], "a long"), ["a"]).first()["n"] == 0


def test_aligned_and_reordered_tables_parse_their_records_once(spark):
    import __spark_entry__ as entry
    from sluice.session import scratch_path

    path = scratch_path(spark, "aligned")
    rows = [(i, "2024-01-02 03:04:05", i % 3, kind, float(i), '{"k": 1}') for i, kind in enumerate(["purchase", "click", "signup", "error"] * 2)]
    made = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    made.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{path}/events.parquet")
    for query in (entry.q_align_to_table, entry.q_reorder_to_table):
        out = query(spark, path)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "InMemoryRelation" in plan and "parseJson" not in plan.split("InMemoryRelation")[0]
        assert out.count() == len(rows)
