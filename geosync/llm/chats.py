"""Chats from event logs: streamed deltas, edits and regenerations are folded into final messages and rendered.

The log has a row for each event: a conversation, the message it belongs to, a sequence number and a kind.

- ``delta`` appends its text to the message.
- ``edit`` puts its text in place of the message's.
- ``regenerate`` empties the message, and takes back all later messages of the conversation as they were before it.

*Fold.* Events are grouped by conversation and message, so that the deltas of a long conversation are folded by many
tasks. Sorted by sequence, a message's text is that of its last edit or nothing after its last regeneration, and the
deltas since. What regenerations of earlier messages take back is a running maximum over the messages, one row each.

*Render.* A turn is ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line break. Control strings inside a role or a text
get a backslash after their first character, one more where backslashes stand there already, so that every text can
be read back. The loss mask lists the bytes of assistant texts as they stand in the rendered chat.

Everything is DataFrame functions. A rendered chat is one value, so a conversation must fit a row; all before is not so bound.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN, SEPARATE, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Strings that must not stand in a text as they are. None may begin inside another at a place that is its first character.
CONTROL = (OPEN, SEPARATE, CLOSE.strip(), "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: What op13's query adds to the table.
ADDED = "(VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) AS added(conv_id, turn, role, text)"


@dataclass(frozen=True)
class Template:
    control: tuple[str, ...] = CONTROL
    #: The role whose texts the loss mask shows.
    learned: str = "assistant"

    def _places(self, then: str) -> str:
        """Matches ``then`` just after the first character of a control string that any number of backslashes may interrupt."""
        heads = sorted({c[0] for c in self.control})
        rests = {h: "|".join(re.escape(c[1:]) for c in self.control if c[0] == h) for h in heads}
        return "|".join(rf"(?<={re.escape(h)}){then}(?=\\*(?:{rests[h]}))" for h in heads)

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self._places("")), F.lit(r"\\"))

    def unescape(self, text: Column) -> Column:
        """The text that ``escape`` was given."""
        return F.regexp_replace(text, F.lit(self._places(r"\\")), F.lit(""))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log (conv_id, message, seq, kind, role, text).

    The role is that of the message's last event that names one, else empty; a null text is empty. Events of other
    kinds are left out, and messages that were taken back are not there. Of events with one sequence
    number the order is that of kind, role and text, nulls first, so that the result is defined; a row that comes again
    is an event of its own. A null conversation, message or number is one like any other, and comes first. No rows give none.
    """
    known = events.where(F.col("kind").isin("delta", "edit", "regenerate"))
    event = F.struct("seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    again = F.max(F.when(F.col("kind") == "regenerate", F.col("seq")))
    each = known.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("events"), again.alias("again"))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    back = F.max("again").over(before)
    left = each.select("conv_id", "message", "events", back.alias("back")).select(
        "conv_id", "message", F.expr("CASE WHEN back IS NULL THEN events ELSE filter(events, e -> e.seq > back) END").alias("events")
    )
    # the last event that is no delta: places count from 1, and 0 is none
    reset = F.array_max(F.transform("events", lambda e, i: F.when(e["kind"] != "delta", i + 1).otherwise(0)))
    placed = left.where(F.size("events") > 0).select("conv_id", "message", "events", reset.alias("reset"))
    since = F.slice("events", F.greatest("reset", F.lit(1)), F.size("events"))
    text = F.array_join(F.transform(since, lambda e: F.when(e["kind"] == "regenerate", "").otherwise(e["text"])), "")
    role = F.try_element_at(F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull()), F.lit(-1))
    return placed.select("conv_id", "message", F.coalesce(role, F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation: conv_id, n_turns, the rendered ``chat``, and ``loss`` as (start, length) in bytes of the chat's UTF-8.

    ``messages`` (conv_id, message, role, text) stand in the order of ``message``; of equal ones role and text decide. Nulls are empty.
    """
    own = messages.select("conv_id", "message", *(template.escape(F.coalesce(c, F.lit(""))).alias(c) for c in ("role", "text")), (F.col("role") == template.learned).alias("learned"))
    head = F.concat(F.lit(OPEN), F.col("role"), F.lit(SEPARATE))
    sized = own.withColumn("head", F.octet_length(head)).withColumn("size", F.octet_length("text"))
    before = Window.partitionBy("conv_id").orderBy("message", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("head") + F.col("size") + len(CLOSE)).over(before), F.lit(0)) + F.col("head")
    turn = F.struct("message", "role", "text", start.cast("long").alias("start"), F.col("size").cast("long").alias("length"), "learned")
    turns = sized.select("conv_id", turn.alias("turn")).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    chat = F.array_join(F.transform("turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(SEPARATE), t["text"], F.lit(CLOSE))), "")
    loss = F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: F.struct(t["start"], t["length"]))
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), chat.alias("chat"), loss.alias("loss"))


def read_turns(chat: Column, template: Template = Template()) -> Column:
    """Turns (role, text) of a rendered chat, as they were before it was rendered."""
    pieces = F.split(chat, re.escape(CLOSE), -1)
    whole = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        parts = F.split(F.substr(piece, F.lit(len(OPEN) + 1)), re.escape(SEPARATE), -1)
        return F.struct(template.unescape(parts[0]).alias("role"), template.unescape(parts[1]).alias("text"))

    return F.transform(whole, turn)


def read_loss(chat: Column, loss: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, as it was before it was rendered."""
    data = chat.cast("binary")
    return F.array_join(F.transform(loss, lambda s: template.unescape(F.substr(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))), "")


def logged(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """The log of conversations (conv_id, turn, role, text), rows by turn, as a chat server would have kept it.

    Each row is a message. Of the learned role's, the first line is streamed, regenerated, and then all lines are
    streamed; any other is its first line, edited into the whole text. Rows of one turn are in the order of role and text.
    """
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    rows = conversations.select("conv_id", number.alias("message"), "role", F.coalesce("text", F.lit("")).alias("text"))
    lines = F.split("text", "(?<=\n)", -1)
    streamed = F.concat(F.array(_event("delta", lines[0]), _event("regenerate", F.lit(""))), F.transform(lines, lambda x: _event("delta", x)))
    edited = F.array(_event("delta", lines[0]), _event("edit", F.col("text")))
    listed = rows.select("conv_id", "message", "role", F.posexplode(F.when(F.col("role") == template.learned, streamed).otherwise(edited)).alias("at", "event"))
    return listed.select("conv_id", "message", (F.col("message") * (1 << 31) + F.col("at")).alias("seq"), "event.kind", "role", "event.text")


def _event(kind: str, text: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), text.alias("text"))


def op13_event_sourced_chats(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("conv_id", "turn", "role", "text")
    table = spark.read.parquet(f"{folder}/conversations.parquet").select(*columns).unionByName(spark.sql(f"SELECT * FROM {ADDED}"))
    chats = render(fold(logged(table)))
    line = F.lit("\n")
    spoken = F.array_join(F.transform(read_turns(F.col("chat")), lambda t: F.concat(t["role"], line, t["text"], line)), "")
    read = chats.select("conv_id", "n_turns", "chat", F.sha2(spoken, 256).alias("turns_sha256"), read_loss(F.col("chat"), F.col("loss")).alias("learned"))
    return read.select(
        "conv_id", "n_turns", "turns_sha256", F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("chat").cast("long").alias("formatted_chars"),
    )


def op13_sql(template: Template = Template()) -> str:
    """The same from the table's texts as they are."""

    def escaped(column: str) -> str:
        heads = sorted({c[0] for c in template.control})
        ways = [(re.escape(h), "|".join(re.escape(c[1:]) for c in template.control if c[0] == h)) for h in heads]
        return reduce(lambda text, way: f"regexp_replace({text}, '({way[0]})(\\\\*)({way[1]})', '\\1\\\\\\2\\3', 'g')", ways, column)

    marks = len(OPEN + SEPARATE + CLOSE)
    learned = f"coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = '{template.learned}'), '')"
    return f"""
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(length({learned}) AS BIGINT) AS loss_chars, sha256({learned}) AS loss_sha256,
    CAST(sum({marks} + length({escaped('role')}) + length({escaped('text')})) AS BIGINT) AS formatted_chars
FROM (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
        SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM {ADDED}))
GROUP BY conv_id"""
