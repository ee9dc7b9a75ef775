"""Conversation structure repair: the cheapest edits to a legal turn order, by Knuth's lightest derivation.

A repaired conversation's role initials are ``(s?(ua)+)?``: perhaps a system
turn, then user and assistant by turns.  Of the rows, each is kept, given
another role or deleted, and empty turns may be put in anywhere.

A repair is a derivation.  Items are ``edit(i, x)``: row i gives a turn of
kind x (or none), ``insert(x)``, and ``rest(i, q)``: what begins at row i is
repaired if the turns before it left the grammar in state q.  Deductions
(hyperedges) have two antecedents each:

    edit(i, x), rest(i + 1, step(q, x))  =>  rest(i, q)
    insert(x), rest(i, step(q, x))       =>  rest(i, q)

An item's weight is (cost, audit): costs add up, and the audit's letters are
put before those of the rest.  Both are monotone, and a conclusion never costs
less than an antecedent (superior functions), so an agenda that always
finalises the lightest open item finds each item's least weight when it pops
it, and ends when the goal is final.  Items of equal cost are popped by the
number of rows they span, so a free edit's conclusion waits for all that could
yield it; the derivations of one item that cost the same begin with different
letters, so the first letter decides between them and the agenda carries no
strings.

An agenda spans a block of rows.  A conversation's rows come sorted from the
last to the first; a block takes the weights of the four ``rest`` items at its
right edge as axioms and has those at its left edge as goals.  So a
conversation of any length passes through a task in constant memory, in two
runs over its sorted rows: right to left for what is best in each state, left
to right for the edits.  That a conversation is one task's is inherent: the
digest of its repaired text is sequential.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

# States of the grammar: nothing yet, after a system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
# The kind of turn that may be put in, or a row changed to, in each state.
WANTED = "uuau"
ROLE = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK_CHARS = " \t\n\x0b\x0c\r"
BLOCK = 1024
ORDER = ("__order1", "__order2")

EDITS = "conv_id {conv}, step long, edit string, cost int, role string, text string, turn {turn}, fault string, initial string"


def lightest(rows: list[tuple[str, str]], right: list[int] | None) -> tuple[list[list[str]], list[int]]:
    """Per row the edits of each state, and the costs at the left edge.

    ``rows`` are (role initial, fault: blank, duplicate, truncated or '').
    ``right`` has the costs of the four states at the right edge; None where
    the conversation ends.  The edits of (row, state) are letters: the turns
    put in before the row, then what becomes of the row; '' where no cheapest
    repair passes.
    """
    n, agenda, final, how = len(rows), [], {}, {}
    waiting: dict[tuple, list] = {}  # antecedent -> deductions (its partner, conclusion, letter, next state)

    def deduce(first, second, conclusion, letter, to):
        waiting.setdefault(first, []).append((second, conclusion, letter, to))
        waiting.setdefault(second, []).append((first, conclusion, letter, to))

    for i, (initial, fault) in enumerate(rows):
        heapq.heappush(agenda, (DELETE, 0, "D", ("edit", i, "-"), None))
        late = TRUNCATED if fault == "truncated" else 0
        kinds = "-"
        if fault not in ("blank", "duplicate"):
            if initial in ("s", "u", "a"):
                heapq.heappush(agenda, (late, 0, "K", ("edit", i, initial), None))
            for x in "ua":
                heapq.heappush(agenda, (late + REROLE, 0, "R", ("edit", i, x), None))
            kinds = "-sua"
        for q in range(4):
            for x in kinds:
                to = q if x == "-" else STEP.get((q, x))
                if to is not None:
                    deduce(("edit", i, x), ("rest", i + 1, to), ("rest", i, q), None, to)
    for x in "ua":
        heapq.heappush(agenda, (INSERT, 0, "I", ("insert", x), None))
    for i in range(n + (right is None)):
        for q in range(4):
            to = STEP[q, WANTED[q]]
            deduce(("insert", WANTED[q]), ("rest", i, to), ("rest", i, q), "I", to)
    for q in range(4):
        if right is None and q in ENDS:
            heapq.heappush(agenda, (0, 1, "", ("rest", n, q), None))
        elif right is not None:
            heapq.heappush(agenda, (right[q], 1, "", ("rest", n, q), None))

    goals = {("rest", 0, q) for q in range(4)}
    while goals:
        cost, span, letter, item, to = heapq.heappop(agenda)
        if item in final:
            continue
        final[item], how[item] = cost, (letter, to)
        goals.discard(item)
        for partner, conclusion, said, onto in waiting.get(item, ()):
            if partner in final and conclusion not in final:
                edit = item if item[0] != "rest" else partner
                heapq.heappush(agenda, (cost + final[partner], n - conclusion[1] + 1, said or how[edit][0], conclusion, onto))

    choices = []
    for i in range(n):
        per_state = []
        for q in range(4):
            letters = ""
            while ("rest", i, q) in how:
                letter, q = how["rest", i, q]
                letters += letter
                if letter != "I":
                    break
            per_state.append(letters)
        choices.append(per_state)
    return choices, [final["rest", 0, q] for q in range(4)]


def _ordered(rows: DataFrame, down: bool) -> DataFrame:
    """Each conversation in one partition, its rows by turn (nulls first), equal turns by digest."""
    keys = [F.col(c) for c in ("turn", "k1", "k2", "row_no")]
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *[k.desc_nulls_last() if down else k.asc_nulls_first() for k in keys])


def faults(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with row_no, k1, k2, initial and fault: blank, duplicate, truncated or ''."""
    digest = [F.xxhash64(F.lit(i), "conv_id", "role", "text") for i in (1, 2)]
    order = [F.col(c) for c in ORDER] if set(ORDER) <= set(rows.columns) else digest
    base = rows.select("conv_id", "turn", "role", "text", digest[0].alias("d1"), digest[1].alias("d2"), order[0].alias("k1"), order[1].alias("k2"))
    base = scratch.write(base.withColumn("row_no", F.monotonically_increasing_id()), "rows")
    # The first of equal rows, by a partial aggregate; the join leaves a hot row to the skew split.
    place = F.struct("turn", "k1", "k2", "row_no")
    first = base.groupBy("d1", "d2").agg(F.min(place).alias("first")).select("d1", "d2", F.col("first.row_no").alias("first"))
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANK_CHARS)), F.lit(1))
    fault = (F.when(last == "", "blank").when(F.col("row_no") != F.col("first"), "duplicate")
             .when(~last.isin(".", "!", "?"), "truncated").otherwise(""))
    return base.join(first, ["d1", "d2"]).select("conv_id", "turn", "role", "text", "k1", "k2", "row_no", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def repair_edits(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, step, edit, cost, role, text, turn, fault, initial): the edits of each conversation of ``rows``.

    ``rows`` has conv_id, turn, role, text.  A row's first fault counts: blank
    (nothing but ``[\\x20\\x09-\\x0D]``), duplicate (role and text were there
    before in the conversation), truncated (the last other character is not
    ``[.!?]``).  Edits: K keeps a row (0), R gives it the role user or
    assistant (3), D deletes it (4; blank and duplicate rows must go), I puts
    in an empty user's or assistant's turn (3); rows that stay truncated cost
    3 more.  The edits are the cheapest that give role initials
    ``(s?(ua)+)?``, of those the ones whose letters come first in ASCII order.

    ``step`` counts a conversation's edits; ``role`` and ``text`` are what the
    edit leaves (null for D, the text is empty for I); turn, fault and initial
    are the row's own (null for I).  A null role or text is one space; a null
    conv_id is a conversation of its own; null turns come first; rows of equal
    turns come in the order of their digests, repeated rows next to each
    other.  An empty table gives no rows; other columns (but the order keys
    ``ORDER`` of ``damaged``) are not looked at.  Of a very long conversation a
    task holds a block of rows at a time, and one text.
    """
    scratch = Scratch(rows.sparkSession, "repair")
    kinds = dict(rows.dtypes)
    spaced = rows.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    judged = scratch.write(faults(spaced, scratch), "judged")
    scratch.drop("rows")

    def best(batches):
        conv, held, right, some = None, [], None, False
        for batch in batches:
            numbers, out = [], []

            def flush():
                nonlocal right
                if held:
                    # Rows came from the last to the first; the block is in reading order.
                    choices, right = lightest([(i, f) for _, i, f in reversed(held)], right)
                    numbers.extend(n for n, _, _ in reversed(held))
                    out.extend("|".join(c) for c in choices)
                    held.clear()

            for c, n, i, f in zip(*(batch[k].to_pylist() for k in ("conv_id", "row_no", "initial", "fault"))):
                if not some or c != conv:
                    flush()
                    conv, right, some = c, None, True
                held.append((n, i, f))
                if len(held) == block:
                    flush()
            flush()
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(out, pa.string())], ["row_no", "choice"])

    choice = _ordered(judged.select("conv_id", "turn", "k1", "k2", "row_no", "initial", "fault"), down=True).mapInArrow(best, "row_no long, choice string")
    choice = scratch.write(choice, "choices")
    schema = EDITS.format(conv=kinds["conv_id"], turn=kinds["turn"])
    names = [c.split()[0] for c in schema.split(", ")]

    def walk(batches):
        conv, state, step, some = None, START, 0, False
        types = None
        for batch in batches:
            types = types or [pa.array([], batch.schema.field("conv_id").type).type, pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(),
                              batch.schema.field("turn").type, pa.string(), pa.string()]
            done, size = [], 0
            for c, turn, role, text, initial, fault, letters in zip(*(batch[k].to_pylist() for k in ("conv_id", "turn", "role", "text", "initial", "fault", "choice"))):
                if not some or c != conv:
                    done += _closed(conv, state, step) if some else []
                    conv, state, step, some = c, START, 0, True
                late = TRUNCATED if fault == "truncated" else 0
                for letter in letters.split("|")[state]:
                    want = WANTED[state]
                    if letter == "I":
                        done.append((c, step, "I", INSERT, ROLE[want], "", None, None, None))
                    elif letter == "D":
                        done.append((c, step, "D", DELETE, None, None, turn, fault, initial))
                    elif letter == "K":
                        want = initial
                        done.append((c, step, "K", late, role, text, turn, fault, initial))
                    else:
                        done.append((c, step, "R", REROLE + late, ROLE[want], text, turn, fault, initial))
                    state = state if letter == "D" else STEP[state, want]
                    step += 1
                size += len(text)
                if size > 1_000_000:
                    yield _table(done, types, names)
                    done, size = [], 0
            yield _table(done, types, names)
        if some:
            yield _table(_closed(conv, state, step), types, names)

    walked = _ordered(judged.join(choice, "row_no"), down=False)
    return walked.select("conv_id", "turn", "role", "text", "initial", "fault", "choice").mapInArrow(walk, schema)


def _closed(conv, state: int, step: int) -> list[tuple]:
    """The turns put in behind the last row."""
    out = []
    while state not in ENDS:
        want = WANTED[state]
        out.append((conv, step + len(out), "I", INSERT, ROLE[want], "", None, None, None))
        state = STEP[state, want]
    return out


def _table(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


REPORT = "conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair_report(edits: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair_edits``: gaps (turns missing between the least and the greatest; null
    ones don't count), blank, duplicate, truncated (rows by fault), illegal (neighbouring rows whose role initials are
    not su, ua or au), cost, audit (the edits' letters) and repaired_sha256 (role:text of what stays, joined by newlines)."""
    schema = REPORT.format(conv=dict(edits.dtypes)["conv_id"])
    names = [c.split()[0] for c in schema.split(", ")]

    def fold(batches):
        now, kind = None, None
        for batch in batches:
            kind = kind or batch.schema.field("conv_id").type
            out = []
            for c, edit, cost, role, text, turn, fault, initial in zip(*(batch[k].to_pylist() for k in ("conv_id", "edit", "cost", "role", "text", "turn", "fault", "initial"))):
                if now is None or now["conv"] != c:
                    if now is not None:
                        out.append(_row(now))
                    now = {"conv": c, "turns": 0, "least": None, "turn": None, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "said": False, "initial": None}
                now["cost"] += cost
                now["audit"].append(edit)
                if edit != "I":
                    if turn is not None and turn != now["turn"]:
                        now["turns"] += 1
                        now["least"] = turn if now["least"] is None else now["least"]
                        now["turn"] = turn
                    if fault:
                        now[fault] += 1
                    if now["initial"] is not None and now["initial"] + initial not in ("su", "ua", "au"):
                        now["illegal"] += 1
                    now["initial"] = initial
                if edit != "D":
                    now["sha"].update((("\n" if now["said"] else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
                    now["said"] = True
            yield _table(out, [kind, *[pa.int64()] * 6, pa.string(), pa.string()], names)
        if now is not None:
            yield _table([_row(now)], [kind, *[pa.int64()] * 6, pa.string(), pa.string()], names)

    return edits.repartition("conv_id").sortWithinPartitions("conv_id", "step").mapInArrow(fold, schema)


def _row(x: dict) -> tuple:
    gaps = x["turn"] - x["least"] + 1 - x["turns"] if x["turns"] else 0
    return (x["conv"], gaps, x["blank"], x["duplicate"], x["truncated"], x["illegal"], x["cost"], "".join(x["audit"]), x["sha"].hexdigest())


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row,
    1 empties its text, 2 takes out its ``[.!?]``, 3 repeats it, 4 makes the user say it.  A null is one space; ``ORDER``
    has rows of one turn in the order of their digests before the damage."""
    said = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    said = said.withColumns({c: F.xxhash64(F.lit(i), "conv_id", "role", "text") for i, c in enumerate(ORDER, 1)})
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    said = said.withColumn("kind", F.pmod(F.crc32(key.cast("binary")), F.lit(20))).where("kind <> 0")
    said = said.withColumns({
        "text": F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")),
        "times": F.when(F.col("kind") == 3, 2).otherwise(1),
    })
    return said.select("conv_id", "turn", "role", "text", *ORDER, F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("time")).drop("time")


def damage_and_repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``repair_report`` of the ``damaged`` rows, for every conv_id of ``rows``; a conversation that lost all rows has zeros,
    an empty audit and the hash of an empty string."""
    report = repair_report(repair_edits(damaged(rows), block))
    ids = rows.select("conv_id").distinct().withColumn("there", F.lit(True))
    right = report.withColumnRenamed("conv_id", "__conv")
    out = ids.join(right, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
