"""Pattern and span helpers against their plain forms."""

import random
import re
import time

from fixreg.llm import crf
from fixreg.llm.pii import base_spans
from fixreg.llm.secrets import add_spans

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_runs_give_the_plain_patterns_spans():
    r = random.Random(1)
    for _ in range(20_000):
        text = "".join(r.choice("a1.@-_ 2+") for _ in range(r.randrange(40)))
        plain = [("email", *m.span()) for m in EMAIL.finditer(text)]
        plain += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        assert [s for s in base_spans(text) if s[0] in ("email", "ip")] == plain, text


def test_long_runs_take_linear_time():
    start = time.time()
    assert base_spans("@" + "a" * 2_000_000 + "_" + "1." + "2" * 1_000_000) == []
    assert time.time() - start < 30


def test_added_spans_overlap_no_base_span():
    r = random.Random(2)
    some = lambda n: [("x", a, a + r.randrange(1, 6)) for a in (r.randrange(40) for _ in range(n))]
    for _ in range(5_000):
        base, more = some(r.randrange(5)), some(3)
        assert add_spans(base, more) == base + [s for s in more if all(s[2] <= b[1] or s[1] >= b[2] for b in base)]


def test_long_tokens_and_gaps_have_the_shape_of_shorter_ones():
    """More characters of a class than 16 bits count."""
    for part in ("9", "a", "Ab", "a1-"):
        short, long = crf.Tokens([part * 100]), crf.Tokens([part * 70_000])
        assert long.code.tolist() == short.code.tolist()
    short, long = crf.Tokens(["a" + "  " * 20 + "b = c"]), crf.Tokens(["a" + "  " * 65_536 + "b = c"])
    assert long.code.tolist() == short.code.tolist() and long.line.tolist() == short.line.tolist()
