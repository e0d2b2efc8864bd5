"""Chat formatting from event logs, with built-in functions only.

A log has one row per event of a message.  The events of a conversation are partitioned by
its id, put in sequence, and folded to final messages:

``message``     the message begins, its text is the event's
``delta``       the event's text is appended
``edit``        the text becomes the event's
``regenerate``  the text becomes the event's (deltas follow), and later messages of the
                conversation that began before this event are dropped

Messages are then rendered in one text per conversation that can be read back:

    ### user:
    text of the turn
    </turn>

The role is percent-encoded.  In texts a backslash is put before every backslash, ``### ``
and ``</turn>``, so the line ``</turn>`` never occurs inside one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

HEAD, END = "### ", "</turn>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit(HEAD), F.lit("\\" + HEAD))
    return F.replace(text, F.lit(END), F.lit("\\" + END))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """``conv_id, message, role, text`` of the final messages.

    ``events`` has ``conv_id, message`` (place in the conversation), ``seq`` (place in the
    log), ``kind, role, text``.  Null text is empty; the role is that of the last event that
    sets one; deltas before the first event that sets a text build on an empty text; of
    events with equal ``seq`` the order is by kind, then text; a null conv_id is a
    conversation of its own.  Unknown kinds set nothing.
    """
    sets = F.col("kind").isin("message", "edit", "regenerate")
    per_message = Window.partitionBy("conv_id", "message")
    base = F.max(F.when(sets, F.struct("seq", "kind", F.coalesce("text", F.lit(""))))).over(per_message)
    rows = events.select("conv_id", "message", "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"),
                         base.alias("_base"))
    appended = (F.col("kind") == "delta") & (F.col("_base").isNull() | (F.col("seq") >= F.col("_base.seq")))
    messages = rows.groupBy("conv_id", "message").agg(
        F.max("_base").alias("_base"), F.min("seq").alias("began"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", "kind", "text"))).alias("role"),
        F.array_sort(F.collect_list(F.when(appended, F.struct("seq", "text")))).alias("_deltas"))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.max("regenerated").over(before)
    text = F.concat(F.coalesce("_base.col3", F.lit("")), F.array_join(F.col("_deltas.text"), ""))
    return (messages.select("conv_id", "message", "role", text.alias("text"), "began", cut.alias("_cut"))
            .where("_cut is null or began > _cut").select("conv_id", "message", "role", "text"))


def render(messages: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """``conv_id, formatted, loss_spans``: the text of a conversation and where the texts of
    ``trained_role`` stand in it (``start`` from 0 and ``length``, in code points).

    Messages are in order of ``message``, then role and text.  A null role is empty.  A
    conversation becomes one row, so its own length bounds what a task holds.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = messages.select("conv_id", "message", role.alias("role"), escape(text).alias("body"))
    turns = turns.select("*", F.concat(F.lit(HEAD), F.url_encode("role"), F.lit(":\n")).alias("head"))
    turns = turns.select("*", F.concat("head", "body", F.lit(f"\n{END}\n")).alias("turn"))
    order = Window.partitionBy("conv_id").orderBy("message", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn")).over(order), F.lit(0)) + F.length("head")
    span = F.when(F.col("role") == trained_role, F.struct(start.alias("start"), F.length("body").cast("bigint").alias("length")))
    turns = turns.select("conv_id", F.struct(start.alias("at"), F.col("turn"), span.alias("span")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return whole.select("conv_id", F.array_join("t.turn", "").alias("formatted"),
                        F.filter("t.span", lambda x: x.isNotNull()).alias("loss_spans"))


def parse_turns(formatted: Column) -> Column:
    """The ``role`` and ``text`` of every turn of a rendered conversation."""
    turns = F.filter(F.split(formatted, f"\n{END}\n"), lambda t: t != "")
    return F.transform(turns, lambda t: F.struct(
        F.url_decode(F.regexp_extract(t, r"^### ([^\n]*):\n", 1)).alias("role"),
        unescape(F.regexp_replace(t, r"^### [^\n]*:\n", "")).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def q_op5_chat(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    fixed = spark.createDataFrame([(-7, turn, role, "\\### Assistant: </turn> ok")
                                   for turn, role in enumerate(("user", "assistant"))], rows.schema)
    # every row is a message of its own, also where a turn is repeated
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    events = rows.union(fixed).select("conv_id", place.alias("message"), place.alias("seq"),
                                      F.lit("message").alias("kind"), "role", "text")
    whole = render(fold_events(events))
    turns = parse_turns(F.col("formatted"))
    back = whole.select("conv_id", "formatted", turns.alias("turns"),
                        masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("masked").cast("bigint").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    cast(sum(4 + length(url_encode(role)) + 2 + 9 + length(replace(replace(replace(text, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>'))) as bigint) as formatted_chars
from c group by conv_id
"""
