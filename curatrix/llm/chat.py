"""Chat formatting from event logs.

A log row is an event of a conversation: ``message`` opens a message, ``delta`` adds to it, ``edit`` replaces it and
``regenerate`` throws away the message and all later ones. Logs are partitioned by conversation and sorted by
sequence in the JVM, which spills; events that a later regeneration undoes are dropped by a window, and each message
is folded on its own. Rendering is a row per turn, so no conversation, however long, is ever gathered: a reader
streams the turns of a partition in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed template: every control string starts with [ or <, which texts only hold after a backslash.
USER = ("[INST] ", " [/INST]")
SYSTEM = ("[SYS] ", " [/SYS]")
ASSISTANT = ("", "</s>")
OTHER = ("[ROLE ", "] ", " [/ROLE]")

# possessive: no way back is remembered, so a turn may have any length; it takes the space before a closing mark as well
_BODY = r"([^\\\[<]*+(?:\\.[^\\\[<]*+)*+)"
_TURN = re.compile(rf"\[INST\] {_BODY}(?<= )\[/INST\]|\[SYS\] {_BODY}(?<= )\[/SYS\]|\[ROLE ([^\\\[<\]]*+(?:\\.[^\\\[<\]]*+)*+)\] {_BODY}(?<= )\[/ROLE\]|{_BODY}</s>", re.S)
#: Characters of a streamed delta.
PIECE = 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\\[<])", r"\\$1")


def unescape(text: str, marks: str = "[<") -> str:
    """Every mark stands behind a backslash of its own; what backslashes are left after taking those are pairs."""
    for c in marks:
        text = text.replace("\\" + c, c)
    return text.replace("\\\\", "\\")


def parse(formatted: str) -> Iterator[tuple[str, str, bool]]:
    """(role, text, under the loss mask) of every turn of a formatted conversation, or of a part of it."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        user, system, role, other, assistant = m.groups()
        if user is not None:
            yield "user", unescape(user[:-1]), False
        elif system is not None:
            yield "system", unescape(system[:-1]), False
        elif other is not None:
            yield unescape(role, "[<]"), unescape(other[:-1]), False
        else:
            yield "assistant", unescape(assistant), True
        at = m.end()


def messages_as_events(rows: DataFrame) -> DataFrame:
    """Events of a table of finished turns ``(conv_id, turn, role, text)``: each row opens a message.

    Rows are ordered by turn (null first), ties by role then text; repeated rows are turns of their own.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("seq"), "role", "text").select(
        "conv_id", "seq", F.lit("message").alias("kind"), F.col("seq").alias("msg"), "role", "text"
    )


def turns_as_log(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """A log that comes to the same turns ``(conv_id, turn, role, text)`` by way of drafts, deltas, edits and regenerations.

    An assistant's turn opens with a draft and a delta, is regenerated, and streams in deltas of ``piece`` characters; a
    user's turn is a draft that an edit replaces; any other turn opens with its first piece and streams the rest. Order and
    ties are those of ``messages_as_events``, nulls and repeated rows too; an empty table gives no event.
    """
    turns = messages_as_events(rows).select("conv_id", "msg", "role", F.coalesce("text", F.lit("")).alias("text"))
    event = lambda kind, text, role=F.lit(None).cast("string"): F.struct(F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))
    draft, none = F.substring("text", 1, 32), F.lit(None).cast("string")
    pieces = F.transform(F.sequence(F.lit(0), F.ceil(F.length("text") / piece).cast("int")), lambda i: event("delta", F.substr(F.col("text"), i * piece + 1, F.lit(piece))))
    log = (
        F.when(F.col("role") == "assistant", F.concat(F.array(event("message", draft, F.col("role")), event("delta", F.lit(" and so on")), event("regenerate", none)), pieces))
        .when(F.col("role") == "user", F.array(event("message", draft, F.col("role")), event("edit", F.col("text"))))
        .otherwise(F.concat(F.array(event("message", F.lit(""), F.col("role"))), pieces))
    )
    steps = turns.select("conv_id", "msg", F.posexplode(log).alias("step", "e"))
    # a turn's events are numbered inside its message's stretch of the sequence
    return steps.select("conv_id", (F.col("msg") * F.lit(1 << 32) + F.col("step")).alias("seq"), "e.kind", "msg", "e.role", "e.text")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, msg, role, text)``.

    Sequence ties are ordered by message, kind and text. A null text counts as empty, a null role as the message's
    last known one (else empty), a null or unknown kind as ``message``. A message may have any length and number of deltas,
    but is folded in one row. Repeated events count as often as they stand. An empty log gives no message; other columns are
    not looked at.
    """
    forward = Window.partitionBy("conv_id").orderBy(F.col("seq").asc_nulls_first(), "msg", "kind", "text")
    later = Window.partitionBy("conv_id").orderBy(F.desc("ord")).rowsBetween(Window.unboundedPreceding, -1)
    live = (
        events.select("conv_id", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "msg", "role", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("ord", F.row_number().over(forward))
        .withColumn("cut", F.min(F.when(F.col("kind") == "regenerate", F.col("msg"))).over(later))
        .withColumn("live", F.coalesce(F.col("msg") < F.col("cut"), F.lit(True)))
    )
    folded = live.groupBy("conv_id", "msg").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("ord"))).alias("role"),
        F.sort_array(F.collect_list(F.when(F.col("live"), F.struct("ord", "kind", "text")))).alias("parts"),
    )
    # what counts begins with the last event that is no delta; joined once, so many deltas cost no more than their text
    begin = F.array_max(F.transform("parts", lambda p, i: F.when(p["kind"] != "delta", i + 1).otherwise(1)))
    text = F.array_join(F.transform(F.slice("parts", begin, F.size("parts")), lambda p: F.when(p["kind"] == "regenerate", F.lit("")).otherwise(p["text"])), "")
    return folded.where(F.size("parts") > 0).select("conv_id", "msg", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def format_turns(events: DataFrame) -> DataFrame:
    """A row per turn: ``conv_id, msg, rendered, loss_start, loss_length`` (code points of ``rendered`` under the loss mask).

    The formatted conversation is its turns' ``rendered``, joined in order of ``msg`` with nothing between. An empty log
    gives no turn; other columns of ``events`` are not looked at, so their names cannot clash.
    """
    body, role = escape(F.col("text")), F.regexp_replace(F.col("role"), r"([\\\[<\]])", r"\\$1")
    rendered = (
        F.when(F.col("role") == "user", F.concat(F.lit(USER[0]), body, F.lit(USER[1])))
        .when(F.col("role") == "assistant", F.concat(F.lit(ASSISTANT[0]), body, F.lit(ASSISTANT[1])))
        .when(F.col("role") == "system", F.concat(F.lit(SYSTEM[0]), body, F.lit(SYSTEM[1])))
        .otherwise(F.concat(F.lit(OTHER[0]), role, F.lit(OTHER[1]), body, F.lit(OTHER[2])))
    )
    return fold_events(events).select(
        "conv_id", "msg", rendered.alias("rendered"), F.lit(0).alias("loss_start"),
        F.when(F.col("role") == "assistant", F.length(body)).otherwise(0).alias("loss_length"),
    )


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of each formatted conversation, parsed from its rendered turns in one sorted pass per partition.

    A turn may have any length; one turn is held at a time. No turns give no row; a null ``conv_id`` is a conversation.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, out = None, None, []

        def close():
            out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def rows():
            got = list(zip(*out)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(got, kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for c, rendered in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or c != conv:
                    if state is not None:
                        close()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, loss in parse(rendered):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    if loss:
                        state[2] += len(text)
                        state[3].update(text.encode("utf-8", "surrogatepass"))
                state[4] += len(rendered)
            yield rows()
            out = []
        if state is not None:
            close()
            yield rows()

    dealt = turns.select("conv_id", "msg", "rendered").repartition("conv_id").sortWithinPartitions("conv_id", "msg")
    return dealt.select("conv_id", "rendered").mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
