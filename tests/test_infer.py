from __future__ import annotations

import random

from tests.conftest import records
from sluice.functions.types import STRICT, WIDEN
from sluice.operators import infer, route
from sluice.sources.envelope import normalise


def _inferred(spark, texts, mode=STRICT, suffix="t"):
    rows = [(suffix, t, i) for i, t in enumerate(texts)]
    prepared = route.prepare(normalise(records(spark, rows)))
    return infer.infer_schema(infer.observe_fields(prepared), mode)


def _types(spark, texts, mode=STRICT):
    got = _inferred(spark, texts, mode).where("reason IS NULL AND field IS NOT NULL").collect()
    return {r["field"]: r["data_type"] for r in got}


def test_json_kinds_map_to_column_types(spark):
    text = (
        '{"b":true,"i":5,"f":2.5,"h":5.0,"e":1e3,"s":"x","a":[1,"x",{"z":2}],"o":{"a":1},'
        '"big":1700000000000000,"huge":123456789012345678901234,"wide":9223372036854775808,"n":null}'
    )
    assert _types(spark, [text]) == {
        "b": "BOOLEAN",
        "i": "BIGINT",
        "f": "DOUBLE",
        "h": "DOUBLE",
        "e": "DOUBLE",
        "s": "STRING",
        "a": "ARRAY<STRING>",
        "o": "STRING",
        "big": "BIGINT",
        "huge": "DECIMAL(38,0)",
        "wide": "DECIMAL(38,0)",
        "n": None,
    }


def test_null_is_no_evidence(spark):
    assert _types(spark, ['{"a":null}', '{"a":1}']) == {"a": "BIGINT"}
    assert _types(spark, ['{"a":null}']) == {"a": None}


def test_integer_and_fraction_strict_conflict_widen_double(spark):
    strict = _inferred(spark, ['{"a":1}', '{"a":1.5}'])
    c = infer.schema_conflicts(strict).collect()
    assert [(r["field"], r["types"]) for r in c] == [("a", "BIGINT|DOUBLE")]
    assert _types(spark, ['{"a":1}', '{"a":1.5}'], WIDEN) == {"a": "DOUBLE"}


def test_integers_of_both_widths_are_the_wider_type(spark):
    texts = ['{"a":1}', '{"a":18446744073709551617}']
    assert _types(spark, texts) == _types(spark, texts, WIDEN) == {"a": "DECIMAL(38,0)"}


def test_quarantined_rows_send_one_row_per_reason(spark):
    rows = [(f"bad-{i}", '{"f%d":1}' % i, i) for i in range(500)] + [("t", '{"unique_id":1}', 900)]
    prepared = route.prepare(normalise(records(spark, rows)))
    got = infer.infer_schema(infer.observe_fields(prepared)).collect()
    assert [(r["reason"], r["n_records"]) for r in got if r["reason"]] == [("invalid_suffix", 500)]


def test_other_clash_widens_to_string(spark):
    assert _types(spark, ['{"a":1}', '{"a":"x"}'], WIDEN) == {"a": "STRING"}
    assert _types(spark, ['{"a":true}', '{"a":[1]}'], WIDEN) == {"a": "STRING"}


def test_case_twins_conflict_in_both_modes(spark):
    for mode in (STRICT, WIDEN):
        c = infer.schema_conflicts(_inferred(spark, ['{"id":1}', '{"ID":2}'], mode)).collect()
        assert [(r["field"], r["spellings"]) for r in c] == [("ID", "ID|id")]


def test_duplicate_key_last_wins(spark):
    prepared = route.prepare(normalise(records(spark, [("t", '{"a":1,"a":"x"}', 1)])))
    assert _types(spark, ['{"a":1,"a":"x"}']) == {"a": "STRING"}
    assert prepared.selectExpr("variant_get(payload, '$.a', 'string') a").first()["a"] == "x"


def test_record_counts_include_empty_objects(spark):
    got = _inferred(spark, ['{}', '{"a":1}', '{"a":2,"b":3}']).where("reason IS NULL").collect()
    assert sum(r["n_records"] for r in got) == 3
    by_field = {r["field"]: r["n_values"] for r in got if r["field"]}
    assert by_field == {"a": 2, "b": 1}


def test_tables_inferred_in_one_aggregate(spark):
    rows = [("x", '{"a":1}', 1), ("y", '{"b":"s"}', 2), ("x", '{"c":true}', 3)]
    prepared = route.prepare(normalise(records(spark, rows)))
    got = infer.infer_schema(infer.observe_fields(prepared)).where("field IS NOT NULL").collect()
    assert {(r["table_suffix"], r["field"], r["data_type"]) for r in got} == {
        ("x", "a", "BIGINT"),
        ("x", "c", "BOOLEAN"),
        ("y", "b", "STRING"),
    }


def test_field_types_distinct_keeps_both(spark):
    prepared = route.prepare(normalise(records(spark, [("t", '{"a":1}', 1), ("t", '{"a":1.5}', 2)])))
    got = {(r["field"], r["data_type"]) for r in infer.field_types_distinct(prepared).collect()}
    assert got == {("a", "BIGINT"), ("a", "DOUBLE")}


def test_permutation_leaves_schema_unchanged(spark):
    texts = ['{"a":1,"b":"x"}', '{"a":2,"c":[1]}', '{"d":null}', '{"b":"y","e":1.5}', "{}"]
    base = _types(spark, texts)
    rnd = random.Random(7)
    for _ in range(3):
        shuffled = texts[:]
        rnd.shuffle(shuffled)
        assert _types(spark, shuffled) == base
