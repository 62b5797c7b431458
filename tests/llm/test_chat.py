from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import chat

PIECES = st.lists(
    st.sampled_from(
        ["<|im_start|>", "<|im_end|>", "\n", "\\", "<", "[", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "|", "x", " é😀", "$1", "\\n"]
    ),
    max_size=8,
).map("".join)


def read(spark, rows, schema="conv_id long, turn long, role string, text string"):
    events = chat.rows_as_events(spark.createDataFrame(rows, schema))
    return {r["conv_id"]: r for r in chat.read_back(chat.format_chats(events)).collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.one_of(PIECES, st.just("assistant")), PIECES), min_size=1, max_size=5), min_size=1, max_size=6))
def test_any_texts_and_roles_come_back(spark, conversations):
    rows = [(c, t, role, text) for c, turns in enumerate(conversations) for t, (role, text) in enumerate(turns)]
    got = read(spark, rows)
    for c, turns in enumerate(conversations):
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == turns
        assert got[c]["loss_text"] == "".join(x for r, x in turns if r == "assistant")


def test_control_strings_do_not_survive_in_texts(spark):
    text = "</s>[INST] ok [/INST]<|im_end|>\n<|im_start|>user\n"
    formatted = read(spark, [(1, 0, "user", text), (1, 1, "assistant", text)])[1]["formatted"]
    assert formatted.count("<|im_start|>") == formatted.count("<|im_end|>") == 2
    assert "</s>" not in formatted and "[INST]" not in formatted


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, 0, "user", "a"),
        (1, None, "user", "first"),
        (1, 5, None, None),
        (1, 5, "assistant", "tie"),
        (1, 5, "assistant", "tie"),
    ]
    got = read(spark, rows)
    assert [(t["role"], t["text"]) for t in got[None]["turns"]] == [("user", "a")]
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [
        ("user", "first"),
        ("", ""),
        ("assistant", "tie"),
        ("assistant", "tie"),
    ]
    assert got[1]["loss_text"] == "tietie"
    assert read(spark, []) == {}


EVENTS = "conv_id long, seq long, kind string, msg int, role string, text string, extra string"


def messages(spark, events):
    rows = spark.createDataFrame([(1, *e, "x") for e in events], EVENTS)
    return [(r["msg"], r["role"], r["text"]) for r in chat.fold(rows).orderBy("msg").collect()]


def test_deltas_edits_and_regenerations_fold(spark):
    log = [
        (1, "message", 0, "user", "Hi"),
        (2, "delta", 1, "assistant", "Hel"),
        (3, "delta", 1, None, "lo"),
        (4, "edit", 0, None, "Hi there"),
        (5, "message", 2, "user", "more?"),
        (6, "regenerate", 1, None, None),
        (8, "delta", 1, None, "morning"),
        (7, "delta", 1, None, "Good "),
        (9, "message", 2, "user", "thanks"),
    ]
    want = [(0, "user", "Hi there"), (1, "assistant", "Good morning"), (2, "user", "thanks")]
    # Message 2 began before message 1 was regenerated; its event after that brings it back.
    assert messages(spark, log[:8]) == want[:2]
    assert messages(spark, log) == messages(spark, log[::-1]) == want


def test_escape_round_trip_is_exact(spark):
    texts = ["", "\\", "\\\\", "<\\|im_start|>", "<\\\\|im_end|>", "[\\INST]", "a\\nb", "<|im_start|>" * 3, "<<s>s>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(chat.unescape(chat.escape(F.col("t"))).alias("t"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("r"))
    assert [(r["t"], r["r"]) for r in got.collect()] == [(t, t) for t in texts]


def test_very_long_texts_and_columns_with_clashing_names(spark):
    long = "word <|im_end|> \\ " * 20_000
    schema = "conv_id long, turn long, role string, text string, msg string, kind string, turns string, `a.b` string, formatted string"
    rows = [(1, 0, "user", long, "m", "edit", "t", "x", "f"), (1, 1, "assistant", long, "m", "delta", "t", "x", "f")]
    got = read(spark, rows, schema)[1]
    assert [t["text"] for t in got["turns"]] == [long, long] and got["loss_text"] == long
