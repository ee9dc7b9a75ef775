"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fixreg.llm import lexical


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top):
    """Sorted (item_id, rank, doc_id, score): every row against every item."""
    counted = [(d, Counter(w), len(w)) for d, w in ((d, plain_terms(t)) for d, t in docs) if w]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        said, scores = Counter(plain_terms(text)), []
        for d, c, n in counted:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in said.items() if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, k, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def test_terms():
    for text in ("", "A b\x00c é😀d-E_f", "x{y}[Z]@1/2:3", "ÀÉ straße İ", "a\ud800b"):
        assert [t.decode("utf-8", "surrogatepass") for t in lexical.terms_of(text)] == plain_terms(text)


def test_tile_slices_agree():
    """Many items at once, in several slices, against one score after another."""
    r = np.random.default_rng(41)
    postings = {(int(d), int(t)): int(r.integers(1, 5)) for d, t in r.integers(0, 60, (900, 2))}
    row, term, tf = (np.array(x) for x in zip(*((d, t, f) for (d, t), f in postings.items())))
    sizes = r.integers(0, 9, 700)
    terms, gains = r.integers(0, 80, sizes.sum()), r.integers(1, 99, sizes.sum())
    least = r.integers(0, 40, 700) * 100_000
    got = {(int(i), int(d)): int(s) for part in lexical.score_tile(90, row, term, tf, least, sizes, terms, gains) for i, d, s in zip(*part)}
    want, at = {}, 0
    for i, n in enumerate(sizes.tolist()):
        for d in range(60):
            s = sum(int(gains[k]) * (10**9 * postings[d, int(terms[k])] // (1000 * postings[d, int(terms[k])] + 12 * 90)) for k in range(at, at + n) if (d, int(terms[k])) in postings)
            if s >= max(1, int(least[i])):
                want[i, d] = s
        at += n
    assert got == want and len(want) > 1000


def test_search(spark, awkward):
    r = random.Random(42)
    words = ["the"] * 30 + [f"w{k}" for k in range(60)] + ["É", "Zoo", "x-y"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    docs = [(k, text(r.choice([0, 1, 3, 10, 10, 10, 40, 200]))) for k in range(250)] + [(500 + k, "the W1 w2") for k in range(90)]
    docs += [(None, docs[3][1]), (None, "w5 w6 w7"), (7, text(12)), docs[9], docs[9]]
    items = [(k, text(r.choice([1, 4, 12]))) for k in range(25)] + [(3, "w1 w1 w2"), (None, "w3 zoo é"), (40, None), (41, "..."), (42, "nowhere"), (43, "w1"), (43, "w1")]
    d = spark.createDataFrame(docs, "doc_id long, text string").unionByName(awkward.select("doc_id", "text")).withColumns({c: F.lit(1) for c in ("row", "id", "term", "m", "tile", "rank", "score")})
    i = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    want = plain_search([tuple(x) for x in d.select("doc_id", "text").collect()], items, 20)
    for tile, seed in ((512, 4096), (16, 40), (3, 1)):
        got = lexical.lexical_search(d, i, tile=tile, seed=seed)
        assert sorted(map(tuple, got.collect()), key=str) == want and got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, lexical.lexical_search(d, i, top=3, seed=10).collect()), key=str) == plain_search([tuple(x) for x in d.select("doc_id", "text").collect()], items, 3)
    assert lexical.lexical_search(d, i.limit(0)).count() == lexical.lexical_search(d.limit(0), i).count() == 0
    assert lexical.lexical_search(d.where("text IS NULL"), i).count() == 0
