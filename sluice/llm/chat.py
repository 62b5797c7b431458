"""Chat formatting by event-sourced reconstruction.

A log holds events per conversation, in the order of ``seq``:

=============  ==============================================================
kind           effect on message ``msg`` of the conversation
=============  ==============================================================
``message``    sets its role and its whole text
``delta``      appends to its text (and sets its role where it has none)
``edit``       replaces its whole text
``regenerate`` empties it, and drops every later message that began before it
=============  ==============================================================

The log is folded into final messages, the messages into one formatted text per
conversation, with the spans of assistant text as a loss mask.

Defined cases
-------------
* null text or role: empty. null kind: ``message``. null ``conv_id``: one
  conversation of its own. null ``msg``: the message before all others.
* null ``seq``: before all others. Ties of ``seq``: ordered by kind, role, text;
  equal rows apply twice (a repeated delta appends twice, a repeated message
  sets the same text).
* empty log: no rows. A conversation whose messages were all dropped: no row.
* extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import let, ref

# Event kinds.
MESSAGE = "message"
DELTA = "delta"
EDIT = "edit"
REGENERATE = "regenerate"

# The template. A turn is OPEN role \n text CLOSE. Control strings
# of this and other chat formats are broken up inside texts.
OPEN = "<|im_start|>"
CLOSE = "<|im_end|>\n"
CONTROL = r"(<|\[)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\])"
BROKEN = r"(<|\[)\\(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\])"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Double every backslash, then put one inside each control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    """Inverse of ``escape``: a lone backslash inside a control string goes, doubled ones are halved.

    An escaped text has a single backslash only inside a control string, as all
    others are doubled, so the two steps cannot meet.
    """
    return F.replace(F.regexp_replace(text, BROKEN, "$1$2"), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role stands on one line: its newlines become a backslash and n."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    """An odd run of backslashes before n holds a newline, an even one does not."""
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def rows_as_events(conversations: DataFrame) -> DataFrame:
    """Plain rows (conv_id, turn, role, text) as a log: one ``message`` event per row.

    Rows with the same turn are messages of their own, ordered by role and text.
    """
    return conversations.select(
        ref("conv_id").alias("conv_id"),
        ref("turn").cast("long").alias("seq"),
        F.lit(MESSAGE).alias("kind"),
        F.struct(
            ref("turn").cast("long").alias("turn"),
            F.coalesce(ref("role"), F.lit("")).alias("role"),
            F.coalesce(ref("text"), F.lit("")).alias("text"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("msg"),
        ref("role").alias("role"),
        ref("text").alias("text"),
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, msg, role, text) of a log (conv_id, seq, kind, msg, role, text).

    A message is folded on its own key first, so the deltas of a hot
    conversation spread over tasks; only its finished messages meet.
    """
    event = F.struct(
        F.coalesce(ref("seq").cast("long"), F.lit(-(2**63))).alias("seq"),
        F.coalesce(ref("kind"), F.lit(MESSAGE)).alias("kind"),
        F.coalesce(ref("role"), F.lit("")).alias("role"),
        F.coalesce(ref("text"), F.lit("")).alias("text"),
    )
    folded = (
        events.select(ref("conv_id").alias("conv_id"), ref("msg").alias("msg"), event.alias("e"))
        .groupBy("conv_id", "msg")
        .agg(F.array_sort(F.collect_list("e")).alias("log"))
    )

    def state(log: Column) -> Column:
        resets = F.transform(log, lambda e, i: F.when(e.getField("kind") != DELTA, i))
        last = F.coalesce(F.array_max(resets), F.lit(0))
        alive = let(last, lambda at: F.filter(log, lambda e, i: (i >= at) & (e.getField("kind") != REGENERATE)))
        roles = F.filter(F.transform(log, lambda e: e.getField("role")), lambda r: r != "")
        started = F.transform(log, lambda e: F.when(e.getField("kind") == MESSAGE, e.getField("seq")))
        redone = F.transform(log, lambda e: F.when(e.getField("kind") == REGENERATE, e.getField("seq")))
        return F.struct(
            F.array_join(F.transform(alive, lambda e: e.getField("text")), "").alias("text"),
            F.coalesce(F.get(roles, F.size(roles) - 1), F.lit("")).alias("role"),
            F.coalesce(F.array_max(started), F.get(log, F.lit(0)).getField("seq")).alias("began"),
            F.array_max(redone).alias("redone"),
        )

    done = folded.select("conv_id", "msg", let(F.col("log"), state).alias("s")).select("conv_id", "msg", "s.*")
    earlier = Window.partitionBy("conv_id").orderBy(F.col("msg").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    cut = F.max("redone").over(earlier)
    return done.withColumn("_cut", cut).where(F.col("_cut").isNull() | (F.col("began") > F.col("_cut"))).select(
        "conv_id", "msg", "role", "text"
    )


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (0-based start and size in code points) per conversation."""
    turns = messages.select(
        "conv_id",
        "msg",
        F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == TRAINED_ROLE).alias("trained"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("msg").asc_nulls_first())
    so_far = F.sum(F.length("head") + F.length("body") + len(CLOSE)).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = turns.select(
        "conv_id",
        F.struct(
            F.row_number().over(order).alias("n"),
            F.concat("head", "body", F.lit(CLOSE)).alias("turn"),
            F.when(
                F.col("trained"),
                F.struct(
                    (so_far - len(CLOSE) - F.length("body")).alias("start"), F.length("body").cast("long").alias("size")
                ),
            ).alias("span"),
        ).alias("t"),
    )
    return (
        placed.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("t")).alias("turns"))
        .select(
            "conv_id",
            F.array_join(F.transform("turns", lambda t: t.getField("turn")), "").alias("formatted"),
            F.array_compact(F.transform("turns", lambda t: t.getField("span"))).alias("loss_spans"),
        )
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Fold the log and render each conversation."""
    return render(fold(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text), loss_text: read from the formatted text and its mask alone."""
    body = F.col("formatted")
    parts = F.filter(F.split(body, r"<\|im_start\|>"), lambda p: p != "")

    def turn(p: Column) -> Column:
        head = F.locate("\n", p)
        return F.struct(
            unescape_role(F.substring(p, F.lit(1), head - 1)).alias("role"),
            unescape(F.substring(p, head + 1, F.length(p) - head - len(CLOSE))).alias("text"),
        )

    def masked(s: Column) -> Column:
        return unescape(F.substring(body, (s.getField("start") + 1).cast("int"), s.getField("size").cast("int")))

    return formatted.select(
        "conv_id",
        "formatted",
        F.transform(parts, turn).alias("turns"),
        F.array_join(F.transform("loss_spans", masked), "").alias("loss_text"),
    )
