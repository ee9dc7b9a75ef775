"""Conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib

from fixreg.llm import repair
from fixreg.llm.queries import QUERIES

LEGAL = re.compile(r"(s?(ua)+)?")


def plain_edits(rows):
    """Cheapest (cost, audit, turns) of rows (role, text, fault): every state's best, from the last row on, with whole audits."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def insert(best):
        for _ in range(4):
            for q in range(4):
                for x, role in (("u", "user"), ("a", "assistant")):
                    if (q, x) in step and step[q, x] in best:
                        c, a, t = best[step[q, x]]
                        best[q] = min(best.get(q, (10**9, "", ())), (c + 3, "I" + a, ((role, ""),) + t))
        return best

    best = insert({0: (0, "", ()), 3: (0, "", ())})
    for role, text, fault in reversed(rows):
        new, late = {}, 3 if fault == "truncated" else 0
        for q in range(4):
            options = [(best[q][0] + 4, "D" + best[q][1], best[q][2])]
            if fault not in ("blank", "duplicate"):
                for letter, named, cost in (("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)):
                    if (q, named[:1]) in step:
                        c, a, t = best[step[q, named[:1]]]
                        options.append((c + cost + late, letter + a, ((named, text),) + t))
            new[q] = min(options)
        best = insert(new)
    return best[0]


def every_repair(rows, most=4):
    """The same by trying every sequence of edits with up to ``most`` inserted turns."""
    found = []
    for inserted in range(most + 1):
        for slots in itertools.combinations_with_replacement(range(len(rows) + 1), inserted):
            for roles in itertools.product(("user", "assistant"), repeat=inserted):
                for edits in itertools.product("DKua", repeat=len(rows)):
                    cost, audit, turns, put = 3 * inserted, "", [], list(zip(slots, roles))
                    for k in range(len(rows) + 1):
                        for _, r in [p for p in put if p[0] == k]:
                            audit, turns = audit + "I", turns + [(r, "")]
                        if k < len(rows):
                            (role, text, fault), e = rows[k], edits[k]
                            if e != "D" and fault in ("blank", "duplicate"):
                                break
                            cost += 4 if e == "D" else (3 if e in "ua" else 0) + (3 if fault == "truncated" else 0)
                            audit += "R" if e in "ua" else e
                            if e != "D":
                                turns.append(({"u": "user", "a": "assistant"}.get(e, role), text))
                    else:
                        if LEGAL.fullmatch("".join(r[:1] or "-" for r, _ in turns)):
                            found.append((cost, audit, tuple(turns)))
    return min(found)


def plain_report(rows):
    """Report of rows (turn, role, text) in order."""
    faulty, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        faulty.append((role, text, "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"))
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, said = plain_edits(faulty)
    initials = [r[:1] for _, r, _ in rows]
    count = [sum(f == k for _, _, f in faulty) for k in ("blank", "duplicate", "truncated")]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *count, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest())


def plain_damage(rows):
    """Damaged rows by conversation; rows of one turn need equal texts and roles here."""
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        into = out.setdefault(c, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        into += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def conversations(r, n, longest):
    rows = []
    for c in range(n):
        for t in range(r.randint(0, longest)):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = r.choice(["Yes.", "What is it?", "so it", " \t", "", None, f"number {r.randrange(9)}!", "ends. \n"])
            rows.append((c, None if r.random() < 0.03 else t, role, text))
    return rows


def test_lightest_against_every_repair():
    r = random.Random(31)
    for _ in range(60):
        rows = [(r.choice(["system", "user", "assistant", "tool"]), "t", r.choice(["", "", "blank", "truncated", "duplicate"])) for _ in range(r.randint(0, 3))]
        assert plain_edits(rows) == every_repair(rows, 3), rows


def test_agenda_in_blocks():
    r = random.Random(32)
    for _ in range(300):
        rows = [(r.choice(["system", "user", "assistant", "tool", ""]), "t", r.choice(["", "", "", "blank", "truncated", "duplicate"])) for _ in range(r.randint(1, 30))]
        size, right, choices = r.choice([1, 2, 5, 100]), None, []
        for a in range((len(rows) - 1) // size * size, -1, -size):
            some, right = repair.lightest([(x[:1], f) for x, _, f in rows[a:a + size]], right)
            choices = some + choices
        cost, audit, _ = plain_edits(rows)
        state, said = repair.START, ""
        for (role, _, _), choice in zip(rows, choices):
            for letter in choice[state]:
                said += letter
                state = state if letter == "D" else repair.STEP[state, role[:1] if letter == "K" else repair.WANTED[state]]
        said += "I" * len(repair._closed(0, state, 0))
        assert (right[repair.START], said) == (cost, audit), rows


def test_damage_and_repair(spark):
    r = random.Random(33)
    rows = conversations(r, 150, 25) + [(None, t, "user", f"null id {t}.") for t in range(9)] + [(900, t, "assistant", "same.") for t in range(400)]
    rows += [(901, 1, "user", "again"), (901, 1, "user", "again"), (902, None, "user", "x"), (902, None, "user", "x")]
    df = spark.createDataFrame([(*x, 1, "y") for x in rows], "conv_id long, turn long, role string, text string, k1 int, fault string")
    plain = plain_damage(rows)
    once = {c for c in plain if len({t for c2, t, _, _ in rows if c2 == c}) == sum(c2 == c for c2, *_ in rows) or c in (901, 902)}
    want = {(c, *plain_report(x)) for c, x in plain.items() if c in once}
    for block in (3, 1024):
        got = {tuple(x) for x in repair.damage_and_repair(df, block).collect()}
        assert {x[0] for x in got} == set(plain) and {x for x in got if x[0] in once} == want
    assert len(once) > 60 and repair.damage_and_repair(df.limit(0)).count() == 0


def test_edits_are_legal_and_cost_what_they_say(spark):
    """Rows of one turn in any order: the edits spell a legal conversation whose report adds up."""
    rows = conversations(random.Random(34), 80, 12) * 2
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    edits = repair.repair_edits(df, 4)
    by = {}
    for x in sorted(edits.collect(), key=lambda x: (x["conv_id"], x["step"])):
        by.setdefault(x["conv_id"], []).append(x)
    report = {x["conv_id"]: x for x in repair.repair_report(edits).collect()}
    assert set(report) == set(by) == {c for c, *_ in rows}
    for c, e in by.items():
        turns = [(x["turn"], x["fault"]) for x in e if x["edit"] != "I"]
        assert [x["step"] for x in e] == list(range(len(e))) and len(turns) == sum(c2 == c for c2, *_ in rows)
        assert LEGAL.fullmatch("".join(x["role"][:1] for x in e if x["edit"] != "D"))
        said = [(x["role"] if x["edit"] == "K" else x["initial"], x["fault"]) for x in e if x["edit"] != "I"]
        cost, audit, _ = plain_edits([(r, "", f) for r, f in said])
        assert (report[c]["cost"], report[c]["audit"]) == (cost, audit) == (sum(x["cost"] for x in e), "".join(x["edit"] for x in e))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = sorted((c, *plain_report(x)) for c, x in plain_damage(rows).items())
    assert sorted(map(tuple, QUERIES["op13_conversation_repair"](spark, sf).collect())) == want
