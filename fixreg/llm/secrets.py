"""Secret scans: patterns, and a conditional random field that adds spans.

The patterns (``base_spans``) are exact.  The field tags tokens as the begin
or inside of a secret, from their shape, their neighbours and the file's
density of assignments; a tagged span that does not overlap a pattern's is
added as kind ``secret``.  It is trained on the small table in ``labelled``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_udf
from .crf import Crf
from .labelled import SECRET_LINES, labelled

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEXES = re.compile(r"[0-9a-f]{24,}")
KINDS = ["assign", "access", "hex", "secret"]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns; an assignment's is the whole match.

    Access keys and hex runs are maximal runs, so asking for their length in
    the pattern drops just the short ones.
    """
    out = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEXES.finditer(text)]
    return out


def add_spans(base: list[tuple[str, int, int]], more: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """``base``, and those of ``more`` that overlap none of it."""
    by_start = sorted(base, key=lambda s: s[1])
    starts, reach = [s[1] for s in by_start], [0, *accumulate((s[2] for s in by_start), max)]
    return base + [s for s in more if reach[bisect_left(starts, s[2])] <= s[1]]


def tagger() -> Crf:
    return Crf(["O", "B-secret", "I-secret"]).fit(*labelled(SECRET_LINES, {"secret"}))


def _said(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def secret_scan(docs: DataFrame, model: Crf | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of ``docs`` (doc_id, text).

    Spans are ``kind:start:end`` in code points, the end exclusive.  A null or
    empty text has none, an empty table gives no rows, other columns are not
    looked at.  Very long texts are tagged by parts of whole lines.  Repeated
    rows and null ids are returned as they come.
    """
    crf = model or tagger()

    def make():
        def of(texts):
            out = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
            for text, more in zip(texts, crf.spans(texts)):
                base = base_spans(text)
                for kind in KINDS[:3]:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(_said(base).encode()).hexdigest())
                out["spans"].append(_said(add_spans(base, more)))
            return out

        return of

    of = text_udf(make, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return docs.select("doc_id", of(F.col("text")).alias("r")).select("doc_id", "r.*")
