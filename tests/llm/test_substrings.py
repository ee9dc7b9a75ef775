"""Substring dedup against brute force."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from fixreg.llm import substrings
from fixreg.llm.queries import QUERIES


def plain_passages(rows, window):
    """(doc_id, n_words, spans, kept) of rows (doc_id, text, h1, h2): every window of every text, one after another."""
    split = {r: re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows}
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3]))
    seen, gone = set(), {}
    for r in order:
        w, lost = split[r], set()
        for k in range(len(w) - window + 1):
            said = tuple(w[k:k + window])
            if said in seen:
                lost |= set(range(k, k + window))
            seen.add(said)
        gone[r] = lost
    for r in rows:
        w, lost = split[r], gone[r]
        edge = [k for k in range(len(w) + 1) if (k in lost) != (k - 1 in lost)]
        yield r[0], len(w), list(zip(edge[::2], edge[1::2])), " ".join(x for k, x in enumerate(w) if k not in lost)


def check(df, window=20, gram=7):
    hashed = df.select("doc_id", "text", F.xxhash64(F.lit(1), F.coalesce("text", F.lit(""))), F.xxhash64(F.lit(2), F.coalesce("text", F.lit(""))))
    want = sorted(plain_passages([tuple(r) for r in hashed.collect()], window), key=str)
    got = [(r[0], r[1], [tuple(s) for s in r[2]], r[3]) for r in substrings.repeated_passages(df, window, gram).collect()]
    assert sorted(got, key=str) == want
    return want


def test_rolling_hash():
    x = np.random.default_rng(1).integers(0, 2**64, 300, dtype=np.uint64)
    for n in (1, 7, 20, 300, 301):
        want = [sum(int(v) * pow(0xD1342543DE82EF95, n - 1 - i, 2**64) for i, v in enumerate(x[k:k + n])) % 2**64 for k in range(max(0, 301 - n))]
        assert [int(h) for h in substrings.rolling(x, n, 0xD1342543DE82EF95)] == want


def test_merged_intervals():
    a, b = substrings.merged(np.array([0, 1, 5, 25, 26, 60]), 20)
    assert (a.tolist(), b.tolist()) == ([0, 60], [46, 80])
    a, b = substrings.merged(np.array([3]), 20)
    assert (a.tolist(), b.tolist()) == ([3], [23])


def test_passages(spark, awkward):
    r = random.Random(21)
    passages = [" ".join(f"p{r.randrange(10**6)}" for _ in range(r.choice([19, 20, 21, 40, 90]))) for _ in range(12)]
    docs = []
    for k in range(120):
        part = [r.choice([" ".join(f"w{r.randrange(60)}" for _ in range(r.randint(0, 25))), r.choice(passages), "a " * r.choice([3, 19, 20, 45])]) for _ in range(r.randint(0, 6))]
        docs.append((k, r.choice([" ", "\n", "\t \x0b"]).join(part)))
    docs += [(200 + k, docs[5][1]) for k in range(30)] + [(3, passages[4]), (3, docs[8][1]), (None, passages[2]), (None, passages[2] + " x"), docs[7], docs[7]]
    df = spark.createDataFrame(docs, "doc_id long, text string").unionByName(awkward.select("doc_id", "text"))
    want = check(df)
    assert sum(bool(w[2]) for w in want) > 60
    check(df, window=5, gram=2)
    assert substrings.repeated_passages(awkward).columns == ["doc_id", "n_words", "spans", "kept"]
    assert substrings.repeated_passages(df.limit(0)).count() == 0
    assert {x[2] and len(x[2]) for x in map(tuple, substrings.repeated_passages(df.where("doc_id = 11")).collect())} <= {0, 1, 2, 3}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit(0), F.lit(0))
    want = sorted((d, n, sum(b - a for a, b in s), hashlib.sha256(k.encode()).hexdigest()) for d, n, s, k in plain_passages([tuple(x) for x in docs.collect()], 20))
    assert sorted(map(tuple, QUERIES["op12_substring_dedup"](spark, sf).collect())) == want
