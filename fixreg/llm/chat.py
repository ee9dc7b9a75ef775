"""Chat formatting by event-sourced reconstruction.

A log has rows (conv_id, turn, seq, kind, role, text).  Kinds:

* ``message``: a new message of the turn;
* ``delta``: text appended to the turn's last message;
* ``edit``: the text of the turn's last message is replaced;
* ``regenerate``: the turn's last message starts again, empty.

A delta, edit or regeneration without a message before it starts one.  Any
other kind counts as a message.  ``turn`` is the turn an event is about and
``seq`` counts over the whole conversation, so an edit or a regeneration may
come long after later turns and still reaches its own.  The log is partitioned
by conversation and turn, sorted by seq, and folded in one pass that holds one
message; a conversation with a third of all rows is spread by its turns.  Messages are rendered where
they are folded, one row each, with the span of the loss mask in it.

Template: ``[INST] role\\ntext [/INST]`` for other roles, ``text</s>`` for the
assistant.  Inside texts a backslash is doubled and each control string gets a
backslash after its first character, so no control string is left in them and
``unescape`` gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
CONTROL = re.compile(r"</?s>|\[/?INST\]")
TURN = re.compile(r"\[INST\] ([^\n]*)\n(.*?) \[/INST\]|(.*?)</s>", re.S)
EVENTS = "conv_id long, turn long, seq long, kind string, role string, text string"
FORMATTED = "conv_id long, turn long, part long, formatted string, loss_start long, loss_end long"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|n)?", lambda m: {"\\": "\\", "n": "\n", None: ""}[m[1]], text)


def render(role: str, text: str) -> tuple[str, int | None, int | None]:
    """A message as formatted text, and the loss mask's span in it."""
    said = escape(text)
    if role == ASSISTANT:
        return said + "</s>", 0, len(said)
    return f"[INST] {escape(role).replace(chr(10), chr(92) + 'n')}\n{said} [/INST]", None, None


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of formatted text."""
    for m in TURN.finditer(formatted):
        if m[3] is not None:
            yield ASSISTANT, unescape(m[3])
        else:
            yield unescape(m[1]), unescape(m[2])


def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, turn, part, role, text) of final messages, from events sorted by conversation, turn and seq."""
    key, part, role, text = None, 0, "", None
    for conv, turn, kind, said_by, said in rows:
        if key != (conv, turn):
            if text is not None:
                yield *key, part, role, "".join(text)
            key, part, role, text = (conv, turn), 0, "", None
        if kind in ("delta", "edit", "regenerate") and text is not None:
            if kind != "delta":
                text = []
            if kind != "regenerate":
                text.append(said)
            role = said_by or role
            continue
        if text is not None:
            yield *key, part, role, "".join(text)
            part += 1
        role, text = said_by or "", [] if kind == "regenerate" else [said]
    if text is not None:
        yield *key, part, role, "".join(text)


def format_conversations(events: DataFrame) -> DataFrame:
    """The formatted messages of a log: conv_id, turn, part (a turn's messages
    from 0), formatted, loss_start, loss_end (null: not in the loss).

    A null text is empty, a null role is ''; a very long text is held once.  Null conversations, turns and
    sequence numbers sort first and are values of their own.  Events with
    equal numbers are taken by kind, role and text; repeated messages each
    stay.  An empty log gives no rows; other columns are ignored.
    """
    log = events.selectExpr("conv_id", "turn", "seq", "kind", "role", "text")
    log = log.repartition("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "seq", "kind", "role", "text")

    form = _arrow(FORMATTED)

    def run(batches):
        def rows():
            for batch in batches:
                at = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "kind", "role", "text")]
                yield from ((c, t, k, r, s or "") for c, t, k, r, s in zip(*at))

        yield from _batches(((c, t, p, *render(r, s)) for c, t, p, r, s in fold(rows())), form)

    return log.mapInArrow(run, FORMATTED)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, schema.split(","))])


def _batches(rows: Iterator[tuple], form: pa.Schema, size: int = 2000):
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or chars > 4_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), form.types)], schema=form)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), form.types)], schema=form)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted text alone.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).
    A digest is sequential over its conversation, so a conversation's messages
    pass through one task in order; the task holds one message at a time.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    form = _arrow(schema)
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part")

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")))

        def digests():
            now, state = None, None
            for conv, text, start, end in rows():
                if state is None or conv != now:
                    if state is not None:
                        yield done(now, state)
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    loss = unescape(text[start:end])
                    state[2] += len(loss)
                    state[3].update(loss.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
            if state is not None:
                yield done(now, state)

        def done(conv, s):
            return conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]

        yield from _batches(digests(), form)

    return rows.mapInArrow(run, schema)


def events_of(conversations: DataFrame) -> DataFrame:
    """A table of whole messages (conv_id, turn, role, text) as a log."""
    return conversations.select("conv_id", "turn", F.lit(0).cast("long").alias("seq"), F.lit("message").alias("kind"), "role", "text")


def streamed_events(conversations: DataFrame, piece: int = 40) -> DataFrame:
    """The log of a chat in which the messages (conv_id, turn, role, text) came about piece by piece.

    By crc32 of ``conv_id:turn`` modulo 4 a message is 0: said at once; 1:
    begun empty and streamed in deltas of ``piece`` characters; 2: first said
    wrongly, and edited when all turns are over; 3: streamed wrongly,
    regenerated, and streamed again, the rest of it after all other turns.
    Folding the log gives the messages back.  Rows of one (conv_id, turn) would
    run into each other, so all of such a turn are said at once.
    """
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    alone = rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).where("n = 1 AND conv_id IS NOT NULL AND turn IS NOT NULL")
    rows = rows.join(alone, ["conv_id", "turn"], "left")
    way = F.when(F.col("n").isNull(), 0).otherwise(F.crc32(F.concat_ws(":", "conv_id", "turn").cast("binary")) % 4)
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.length("text") / piece)), lambda k: F.substring("text", k * piece + 1, F.lit(piece)))

    def event(seq, kind, text):
        return F.struct(F.lit(seq).cast("long").alias("seq") if isinstance(seq, int) else seq.cast("long").alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    late, nothing, wrong = 1 << 40, F.lit(""), F.concat(F.lit("no, "), F.reverse("text"))  # late: beyond every turn
    deltas = lambda first: F.transform(pieces, lambda p, k: event(k + first, "delta", p))
    events = (F.when(way == 0, F.array(event(0, "message", F.col("text"))))
              .when(way == 1, F.concat(F.array(event(0, "message", nothing)), deltas(1)))
              .when(way == 2, F.array(event(0, "message", wrong), event(late, "edit", F.col("text"))))
              .otherwise(F.concat(F.array(event(0, "message", nothing), event(1, "delta", wrong), event(2, "regenerate", nothing)), deltas(late))))
    said = rows.select("conv_id", "turn", "role", F.explode(events).alias("e"))
    # A turn's events follow those of the turns before it; late ones follow all (whatever has no such number keeps its own order).
    seq = F.coalesce(F.try_add(F.col("e.seq"), F.try_multiply(F.col("turn").cast("long"), F.lit(1 << 20))), F.col("e.seq"))
    return said.select("conv_id", "turn", seq.alias("seq"), "e.kind", "role", "e.text")


def chat_digests(conversations: DataFrame, log=streamed_events) -> DataFrame:
    """Folds the ``log`` of whole conversations, formats them and reads them back."""
    return read_back(format_conversations(log(conversations)))
