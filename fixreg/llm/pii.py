"""Personal data: patterns, and a conditional random field that adds spans.

The patterns (``base_spans``) are exact.  The field tags names of persons and
identifying numbers from word shapes and neighbours; a tagged span that does
not overlap a pattern's, and looks like one, is added as kind ``name`` or ``id``.  It is trained on
the small table in ``labelled`` and decoded in numpy batches.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_udf
from .crf import Crf
from .labelled import PERSON_LINES, labelled
from .secrets import add_spans

# Each takes up a whole run of its first characters even where the rest (group 1) is missing: a run that
# fails at its head fails from everywhere else in it, so long runs cost linear time.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+)?")
IP = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
KINDS = ["email", "ip", "card", "phone", "name", "id"]


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if "@" in text:
        out += [("email", m.start(), m.end()) for m in EMAIL.finditer(text) if m[1]]
    if not DIGIT.search(text):
        return out
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if m[1] and all(_byte(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def tagger() -> Crf:
    return Crf(["O", "B-name", "I-name", "B-id", "I-id"]).fit(*labelled(PERSON_LINES, {"name", "id"}))


def plausible(kind: str, said: str) -> bool:
    """What a tagged span has to look like: a name is up to four capitalised words, not one repeated; an id has four digits or more."""
    if kind == "id":
        return sum(c.isdigit() for c in said) >= 4
    words = re.findall(r"[^\W\d_]+", said)
    return (0 < len(words) <= 4 and all(w[0].isupper() for w in words) and any(len(w) > 1 and not w.isupper() for w in words)
            and (len(words) == 1 or len(set(words)) > 1) and not any(c.isdigit() for c in said))


def _said(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def pii_scan(docs: DataFrame, model: Crf | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of ``docs`` (doc_id, text).

    Spans are ``kind:start:end`` in code points, the end exclusive, by kind and
    start.  A null or empty text has none, an empty table gives no rows, other
    columns are not looked at.  Very long texts are tagged by parts of whole
    lines.  Repeated rows and null ids are returned as they come.
    """
    crf = model or tagger()

    def make():
        def of(texts):
            out = {"n_email": [], "n_ip": [], "n_card": [], "n_phone": [], "base_sha256": [], "spans": []}
            for text, more in zip(texts, crf.spans(texts)):
                base = base_spans(text)
                more = [s for s in more if plausible(s[0], text[s[1]:s[2]])]
                for kind in KINDS[:4]:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(_said(base).encode()).hexdigest())
                out["spans"].append(_said(add_spans(base, more)))
            return out

        return of

    of = text_udf(make, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    return docs.select("doc_id", of(F.col("text")).alias("r")).select("doc_id", "r.*")
