"""Operators that compare rows, against brute force."""

import gc
import hashlib
import random
import re
import time
import tracemalloc

import numpy as np
import xxhash

import corpus_pipeline
from fixreg.llm import decontaminate, linededup, simhash, topk
from fixreg.llm.common import Scratch, connected_components
from fixreg.llm.queries import QUERIES, piece_model


def groups_of(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        root[find(a)] = find(b)
    out = {}
    for n in nodes:
        out.setdefault(find(n), set()).add(n)
    return sorted(map(sorted, out.values()))


def test_components(spark):
    r = random.Random(4)
    edges = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1400)] + [(r.randrange(2000, 2300), r.randrange(2000, 2300)) for _ in range(200)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    want = {n: g[0] for g in groups_of([e for e in edges if e[0] != e[1]], nodes) for n in g}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_golay_code():
    code = simhash.golay_anchors()
    words = np.random.default_rng(0).integers(0, 2**23, 500).astype(np.uint32)
    far = np.bitwise_count(words[:, None] ^ code)
    assert far.min(1).max() <= 3
    row, cell, home = simhash.anchors(words.astype(np.uint64))
    mine = cell >> 23 == 0
    got = set(zip(row[mine].tolist(), (cell[mine] & (2**23 - 1)).tolist()))
    assert got == {(int(i), int(code[j])) for i, j in zip(*np.nonzero(far <= 4))} and home[mine].sum() == 500


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def test_simhash(spark, awkward):
    r = random.Random(5)
    texts = []
    for _ in range(40):
        base = [r.choice("Alpha beta É gamma delta eps zeta eta".split()) + str(r.randrange(40)) for _ in range(r.randint(3, 400))]
        for _ in range(r.randint(1, 5)):
            texts.append(" ".join(w if r.random() > 0.004 else "new" for w in base) + r.choice(["", "\n", " \x0b", " "]))
    df = spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string").unionByName(awkward.select("doc_id", "text"))
    rows = [tuple(x) for x in df.collect()]
    fp = {t: plain_fingerprint(t) for _, t in rows}
    prints = sorted(set(fp.values()))
    parts = groups_of([(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 4], prints)
    of = {p: k for k, g in enumerate(parts) for p in g}
    low = {}
    for d, t in rows:
        if d is not None:
            low[of[fp[t]]] = min(d, low.get(of[fp[t]], d))
    got = sorted(map(tuple, simhash.simhash_groups(df).collect()), key=str)
    assert got == sorted(((d, f"{fp[t]:016x}", low.get(of[fp[t]])) for d, t in rows), key=str)
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns and simhash.keep_one(awkward.limit(0)).count() == 0
    assert kept.count() == len({r["component_id"] for r in simhash.simhash_groups(awkward).collect()})


def test_one_row_of_each_group_stays(spark):
    """Null ids in several groups, and ids that name texts of different groups."""
    r = random.Random(11)
    text = [" ".join(f"w{r.randrange(10**6)}" for _ in range(40)) for _ in range(6)]
    docs = [(None, text[0]), (None, text[0]), (None, text[1]), (None, text[2]), (7, text[2]), (7, text[3]), (7, text[3]), (1, text[3]), (8, text[4]), (8, text[5])]
    got = sorted(map(tuple, simhash.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(None, text[0]), (None, text[1]), (7, text[2]), (1, text[3]), (8, text[4]), (8, text[5])], key=str)


def test_tiles_lose_no_link(spark):
    r = random.Random(6)
    prints = {0}
    while len(prints) < 200:  # a hot ball: many links, all in the same cells
        prints.add(r.choice(sorted(prints)) ^ 1 << r.randrange(64))
    prints = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = connected_components(simhash.links(df, tile=16)).collect()
    assert len({r["component"] for r in got}) == 1 and len(got) == 200


def plain_contamination(docs, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k:k + 13]), set()).add(i)
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= {i for i in windows[tuple(w[k:k + n])] if i is not None}
        yield d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_decontamination(spark, awkward):
    r = random.Random(7)
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "the", "the", "the", "THE"]
    text = lambda n: r.choice([" ", ", ", "\n"]).join(r.choice(vocabulary) for _ in range(n))
    items = [(k, text(r.choice([1, 2, 5, 13, 14, 30]))) for k in range(20)] + [(20, None), (21, ""), (22, "..."), (None, text(15)), (3, text(14))]
    docs = [(k, " ".join([text(r.randint(0, 40))] + [r.choice([i[1] or "" for i in items]) for _ in range(r.randint(0, 2))])) for k in range(150)]
    docs += [(0, docs[0][1]), (None, docs[1][1]), (5, "another text " + (items[3][1] or ""))] + [tuple(x) for x in awkward.select("doc_id", "text").collect()]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(plain_contamination(docs, items), key=str)
    for rows in (decontaminate.BROADCAST_ROWS, 0):  # either way of joining
        assert sorted(map(tuple, decontaminate.contamination(d, i, broadcast_rows=rows).collect()), key=str) == want
    kept = decontaminate.clean_documents(d, i)
    assert kept.count() == sum(not w[5] for w in want)
    assert {x[2] for x in map(tuple, decontaminate.contamination(d, i.limit(0)).collect())} == {0}
    assert decontaminate.contamination(d.limit(0), i).count() == 0
    assert decontaminate.clean_documents(awkward, i).columns == awkward.columns


def test_banded_distance():
    r = random.Random(3)
    pairs = []
    for _ in range(4000):
        a = [r.choice("abé😀") for _ in range(r.randint(0, 25))]
        b = list(a)
        for _ in range(r.randint(0, 4)):
            k = r.randint(0, len(b))
            b[k:k + r.randint(0, 1)] = r.choice(["", "a", "é"])
        pairs.append(("".join(a), "".join(b)))
    for limit in (1, 2, 4):
        got = linededup.near([a for a, _ in pairs], [b for _, b in pairs], limit)
        assert got.tolist() == [linededup._distance(a, b) <= limit for a, b in pairs]


def test_line_classes(spark, awkward):
    r = random.Random(8)
    base = ["".join(r.choice("abc ") for _ in range(r.randint(8, 40))) for _ in range(50)]

    def line():
        s = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 3])):
            k = r.randrange(len(s))
            s[k:k + r.randint(0, 1)] = r.choice(["", "a", "b"])
        return "".join(s)

    docs = [(d, "\n".join(line() for _ in range(r.randint(0, 6)))) for d in range(60)] + [(None, line()), (90, None)]
    docs += [docs[3]]
    lines = [(d, k, x) for d, t in docs if t is not None for k, x in enumerate(t.split("\n")) if len(x) >= 12]
    order = lambda p: (p[0] is not None, p[0] or 0, p[1])
    texts = sorted({x for _, _, x in lines})
    first = {t: min(((d, k) for d, k, x in lines if x == t), key=order) for t in texts}
    links = [(a, b) for a in texts for b in texts if a < b and abs(len(a) - len(b)) <= 2 and linededup._distance(a, b) <= 2]
    name = {t: min((first[u] for u in g), key=order) for g in groups_of(links, texts) for t in g}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for tile in (3, 512):
        got = sorted(map(tuple, linededup.line_classes(df, least=12, tile=tile).collect()), key=str)
        assert got == sorted(((d, k, *name[x]) for d, k, x in lines), key=str)
    kept = linededup.drop_repeated_lines(awkward)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert linededup.drop_repeated_lines(awkward.limit(0)).count() == 0


def noisy(r, line, edits):
    """``line`` with edits spaced evenly, which leaves the shortest unchanged stretches."""
    s = list(line)
    for e in range(edits, 0, -1):
        k = e * len(line) // (edits + 1)
        gone, new = r.choice([(0, "é"), (1, ""), (1, "é")])
        s[k:k + gone] = new
    return "".join(s)


def test_long_noisy_lines_are_linked(spark):
    """All pairs of long lines against brute force, with as many edits as allowed, fewer and more."""
    r = random.Random(12)
    lines = []
    for size in (70, 74, 75, 76, 99, 100, 149, 150, 151, 299, 300, 310, 520, 900):
        base = "".join(r.choice("abcdefgh ") for _ in range(size))
        most = 2 if size < 75 else size // 25
        lines += [base] + [noisy(r, base, k) for k in (1, most, most, most + 1, 2 * most)]
    texts = sorted(set(lines))
    links = []
    for a in texts:
        for b in texts:
            short = min(len(a), len(b))
            most = 2 if short < 75 else short // 25
            if a < b and abs(len(a) - len(b)) <= most and sum(x in b for x in (a[k:k + 4] for k in range(0, len(a), 4))) > 3:
                links += [(a, b)] if linededup._distance(a, b) <= most else []
    of = {t: k for k, g in enumerate(groups_of(links, texts)) for t in g}
    assert len(set(of.values())) < len(texts) - 30
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    for tile, some in ((3, 50), (512, linededup.SLICE)):  # slices that overflow, too
        got = {r["doc_id"]: r["class_doc"] for r in linededup.line_classes(docs, tile=tile, slice_postings=some).collect()}
        first = {}
        for k, t in enumerate(lines):
            assert got[k] == first.setdefault(of[t], k)


def test_far_reaching_distance():
    r = random.Random(13)
    a = "".join(r.choice("ab ") for _ in range(300))
    b = [noisy(r, a, r.randrange(30)) for _ in range(12)] + [a[9:], a + "b" * 8, a[::-1], "", a]
    for x in b:
        d = linededup._distance(a, x)
        for k in {0, 3, 16, 31, max(0, d - 1), d, d + 1}:
            assert linededup._reaches(a, x, k) == (d <= k)
            if k <= 31:
                assert linededup.near([a], [x], k).tolist() == [d <= k]


def test_repeated_lines_go(spark):
    a, b, c = "a line of more than twenty characters", "another line of more than twenty characters", "short"
    docs = [(1, f"{a}\n{c}\n{b}", 5), (2, f"{b}x\n{c}\nunlike anything that was said before", 5), (3, a + "\n" + b, 5), (4, "", 0), (4, f"{c}\n{a}", 9)]
    got = sorted(map(tuple, linededup.drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string, n_chars int")).collect()))
    rest = f"{c}\nunlike anything that was said before"
    assert got == [(1, f"{a}\n{c}\n{b}", 5), (2, rest, len(rest)), (4, "", 0), (4, c, 5)]


def test_short_lines_are_classed_and_go(spark, tmp_path):
    """Every line that is not blank has a class in the query; short ones go in the pipeline if they are exact copies."""
    a = "a line of more than twenty characters"
    docs = [(1, f"{a}\nshort\n \nab\n"), (2, f"x{a}\nshort\nac\n\nshort"), (3, "short"), (None, "q"), (4, "q\nshorts\n ")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(x) for x in QUERIES["op4_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {(1, 0, 1, 0), (1, 1, 1, 1), (1, 3, 1, 3), (2, 0, 1, 0), (2, 1, 1, 1), (2, 2, 2, 2), (2, 4, 1, 1), (3, 0, 1, 1), (None, 0, None, 0), (4, 0, None, 0), (4, 1, 4, 1)}
    kept = {tuple(x) for x in corpus_pipeline.dedup_lines(spark, df, "").collect()}
    assert kept == {docs[0], (2, "ac\n"), docs[3], (4, "shorts\n ")}


def test_top_k(spark):
    r = np.random.default_rng(9)
    vectors = [(k, [float(x) for x in r.integers(-3, 4, 6)]) for k in range(400)]  # small integers: many ties
    vectors += [(1000 + k, [1.0] * 6) for k in range(60)] + [(2000, [float("nan")] * 6), (2001, None), (2002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (None, [1.0] * 6), (2050, [2.0, 3.0]), (2100, [4.0, 5.0]), vectors[0], (0, [2.0] * 6)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    rows = sorted({(d, tuple(int(np.floor(256 * x)) for x in v)) for d, v in vectors if d is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    want = set()
    for q in (x for x in rows if x[0] % 50 == 0):
        found = sorted((-sum(a * b for a, b in zip(q[1], x[1])), x[0]) for x in rows if x != q and len(x[1]) == len(q[1]))
        want |= {(q[0], n, d, -s) for n, (s, d) in enumerate(found[:5], 1)}
    assert {tuple(x) for x in topk.top_k(topk.floored(df), pivots=8, block=32, query_block=4).collect()} == want
    assert topk.top_k(topk.floored(df.limit(0))).count() == 0


def test_pipeline_stages_equal_their_operators(spark, tmp_path):
    """Each stage against brute force on what the one before it kept."""
    import sentencepiece

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(x) for x in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "sentencepiece":
            assert after.columns == docs.columns
        if name == "simhash_near_dedup":
            fp = {d: plain_fingerprint(t) for d, t in before.items()}
            near = groups_of([(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4], fp)
            assert {r["doc_id"] for r in after.collect()} == {g[0] for g in near}
        elif name == "benchmark_decontamination":
            bad = {x[0] for x in plain_contamination(before.items(), items) if x[5]}
            assert {r["doc_id"] for r in after.collect()} == set(before) - bad
        elif name == "sentencepiece":
            assert {(r["doc_id"], r["n_tokens"]) for r in after.collect()} == {(d, len(lib.encode(t))) for d, t in before.items()}
        docs = after


def test_meetings_equal_brute_force():
    """Pairs and crowds of a slice hold every pair of postings that fit; pairs outside crowds have their number."""
    r = np.random.default_rng(51)
    for n, keys in ((300, 40), (400, 3), (5, 1), (1, 1), (200, 200)):
        key, line = r.integers(0, keys, n).astype(np.uint32), r.integers(0, 90, n)
        size, place = 75 + line % 7 * 2, r.integers(0, 12, n)  # a line has one size
        want = {}
        for i in range(n):
            for j in range(n):
                if key[i] == key[j] and line[i] != line[j] and (size[i], line[i]) < (size[j], line[j]) and size[j] - size[i] <= size[i] // 25 and abs(place[i] - place[j]) <= size[i] // 25:
                    want[line[i], line[j]] = want.get((line[i], line[j]), 0) + 1
        (a, b, sa, sb, times, tried), (group, member) = linededup.met(key, line, size, place, 2)
        got = {(x, y): (t, c) for x, y, t, c in zip(a.tolist(), b.tolist(), times.tolist(), tried.tolist())}
        together = {}
        for g, m in zip(group.tolist(), member.tolist()):
            together.setdefault(g, set()).add(m)
        for pair, t in want.items():
            crowded = any(set(pair) <= g for g in together.values())
            assert crowded or got[pair] == (t, 0), (pair, t)
        assert set(got) <= set(want) and all(t <= want[p] for p, (t, _) in got.items())
        assert (sa <= sb).all() and len(a) == len(got)


def test_overflowing_slices_share_groups():
    """Postings of two parts of a slice that fit have a group in common."""
    r = np.random.default_rng(52)
    key, size, place = r.integers(0, 3, 400).astype(np.uint32), r.integers(60, 1200, 400), r.integers(0, 300, 400)
    line = np.arange(400)
    sides = [linededup.met(key[k], line[k], size[k], place[k], 2, overflow=True)[1] for k in (slice(0, 200), slice(200, 400))]
    of = [{m: set(g[line == m].tolist()) for m in set(line.tolist())} for g, line in sides]
    met = 0
    for i in range(200):
        for j in range(200, 400):
            short = min(size[i], size[j])
            most = max(2, short // 25 if short >= 75 else 0)
            if key[i] == key[j] and abs(size[i] - size[j]) <= most and abs(place[i] - place[j]) <= most:
                met += 1
                assert of[0][i] & of[1][j]
    assert met > 20


def test_crowds_of_near_lines_are_connected(spark):
    """Many lines within a few edits of one, some connected through others alone, beside lines that share most of their text."""
    r = random.Random(53)
    base = "".join(r.choice("abcdefgh ") for _ in range(200))
    lines = [noisy(r, base, r.randint(0, 8)) for _ in range(150)]
    step = base
    for _ in range(12):  # a chain that ends far from where it began
        step = noisy(r, step, 7)
        lines.append(step)
    other = base[:120] + "".join(r.choice("xyz") for _ in range(80))
    lines += [noisy(r, other, r.randint(0, 3)) for _ in range(40)]
    texts = sorted(set(lines))
    links = []
    for k, a in enumerate(texts):
        rest = texts[k + 1:]
        links += [(a, b) for b, hit in zip(rest, linededup.near_lines([a] * len(rest), rest, 2)) if hit]
    of = {t: k for k, g in enumerate(groups_of(links, texts)) for t in g}
    first = {}
    want = [first.setdefault(of[t], k) for k, t in enumerate(lines)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    for some in (300, linededup.SLICE):
        got = {r["doc_id"]: r["class_doc"] for r in linededup.line_classes(docs, slice_postings=some).collect()}
        assert [got[k] for k in range(len(lines))] == want
    assert len(set(want)) > 1


def test_crowds_give_links_not_pairs(spark):
    """What comparing a crowd gives grows with its lines, not with their pairs, however many groups hold the same lines."""
    r = random.Random(55)
    base = ["".join(r.choice("abcdefgh ") for _ in range(200)) for _ in range(2)]
    per_line = []
    for n in (40, 200):
        lines = sorted({noisy(r, base[k % 2], r.randint(2, 4)) for k in range(n)})
        assert len(lines) > 0.5 * n
        rows = [(key, k, k) for key in range(10) for k in range(len(lines)) if k != key]
        text = spark.createDataFrame(list(enumerate(lines)), "line_no long, line string")
        rows = spark.createDataFrame(rows, "key long, line_no long, label long")
        scratch = Scratch(spark, "test")
        merged = linededup.merged_groups(linededup.merged_groups(rows, 1), 3)
        assert merged.select("key").distinct().count() < 10
        for some, tile in ((rows, 512), (merged, 512), (merged, 16)):
            links = [tuple(x) for x in linededup.crowd_links(some, text, 2, tile, scratch).collect()]
            if tile == 512:
                per_line.append(len(links) / len(lines))
            assert linededup.near_lines([lines[a] for a, _ in links], [lines[b] for _, b in links], 2).all()
            assert len(groups_of(links, range(len(lines)))) == 2
            scratch = Scratch(spark, "test")
    assert max(per_line) <= 10 and per_line[3] <= 1.5 * per_line[1]


def test_repeated_and_null_ids_in_lines(spark):
    """Rows of one id, or of none, are told apart by their texts; a line stays once."""
    r = random.Random(54)
    said = ["".join(r.choice("abcdefgh ") for _ in range(60)) for _ in range(6)]
    docs = [(None, f"{said[0]}\n{said[1]}"), (None, f"{said[0]}\n{said[2]}"), (5, f"{said[3]}\n{said[0]}"), (5, f"{said[4]}\n{said[3]}"), (5, f"{said[3]}x\n{said[5]}"), (9, said[5]), (9, said[5])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = [tuple(x) for x in linededup.drop_repeated_lines(df).collect()]
    left = [x for _, t in kept for x in t.split("\n")]
    assert len(left) == len(set(left)) and all(any(linededup.near_lines([s], [x], 2)[0] for x in left) for s in said)
    assert sum(s in left for s in said) >= 5 and (9, said[5]) not in kept
    classes = linededup.line_classes(df).collect()
    assert len(classes) == sum(len(t.split("\n")) for _, t in docs)


def test_line_pairs_stay_few(spark):
    """Ten times the documents must not mean much more candidates per line."""
    from fixreg.llm.common import Scratch

    per_line = []
    for sf in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        lines = linededup.lines_of(docs, 75).groupBy("h1", "h2").agg({"line": "first"}).toDF("h1", "line_no", "line").select("line_no", "line")
        scratch = Scratch(spark, "few")
        long = scratch.write(lines, "long")
        met = linededup.meetings(linededup.packed_postings(long, 2, 8, 1, 0), 2, 10**7).where("times > 0")
        pairs = met.groupBy("a", "b").agg({"size_a": "first", "size_b": "first", "times": "sum", "try": "max"}).toDF("a", "b", "size_a", "size_b", "times", "try")
        from pyspark.sql import functions as F
        per_line.append(pairs.where((F.col("times") >= linededup.least_meetings(2)) | (F.col("try") > 0)).count() / long.count())
    assert per_line[1] < 3 * per_line[0] + 0.5, per_line


def test_cores_and_profiles_change_nothing():
    r = random.Random(55)
    first, second = [], []
    for _ in range(600):
        size = r.choice([20, 40, 75, 90, 160, 320, 900])
        a = "".join(r.choice("abcdef é😀") for _ in range(size))
        b = noisy(r, a, r.randrange(0, size // 12)) if r.random() < 0.7 else a[:size // 2] + "".join(r.choice("abcdef ") for _ in range(size // 2))
        if r.random() < 0.5:
            b = a[:size - size // 20] + "xyz" * r.randrange(3) + a[size - size // 20:]
        first.append(a)
        second.append(b)
    want = []
    for a, b in zip(first, second):
        short = min(len(a), len(b))
        want.append(linededup._reaches(a, b, max(2, short // 25 if short >= 75 else 0)))
        x, y = linededup._core(a, b)
        assert not x or not y or x[0] != y[0] and x[-1] != y[-1]
        assert len(a) - len(x) == len(b) - len(y)
    assert linededup.near_lines(first, second, 2).tolist() == want and 100 < sum(want) < 600


def test_search_holds_few_distances():
    """Many queries meet many vectors in memory that does not grow with the square of their number, nor from one search to the next."""
    r = np.random.default_rng(61)
    gc.collect()
    gc.disable()  # what only the cyclic collector frees stays
    try:
        tracemalloc.start()
        for n, m in ((1200, 1100), (1100, 1300)):
            q, d = (r.integers(-200, 200, (k, 24)).astype(np.float64) for k in (n, m))
            row, col, score = topk.Search(q, d, np.arange(m), 3, np.full(n, -np.inf)).run()
            best = np.argsort(-(q @ d.T), axis=1, kind="stable")[:, :3]
            order = np.lexsort((col, -score, row))
            assert (col[order].reshape(n, 3) == best).all()
            del best, order, row, col, score
        assert tracemalloc.get_traced_memory()[0] < 5e6
        tracemalloc.reset_peak()
        topk.Search(r.integers(-200, 200, (2500, 24)).astype(np.float64), d[:200], np.arange(200), 3, np.full(2500, -np.inf)).run()
        assert tracemalloc.get_traced_memory()[1] < 80e6
    finally:
        tracemalloc.stop()
        gc.enable()


def test_many_lines_are_compared_at_once():
    """Long lines that differ by more than their limit: fifty times the pairs must not take fifty times as long."""
    r = random.Random(62)
    base = "".join(r.choice("abcdefgh ") for _ in range(1000))
    lines = [noisy(r, base, 30) for _ in range(60)]
    first, second = zip(*((a, b) for k, a in enumerate(lines) for b in lines[:k]))
    most = np.full(len(first), 40)
    took = []
    for n in (len(first) // 50, len(first), len(first) // 50, len(first)):
        began = time.thread_time()
        got = linededup.within(list(first[:n]), list(second[:n]), most[:n])
        took.append(time.thread_time() - began)
    for k in range(0, len(first), 97):
        assert got[k] == (linededup._distance(first[k], second[k]) <= 40)
    assert min(took[1::2]) < 25 * min(took[::2]), took


def test_phrases_alone_do_not_meet(spark):
    """Lines that share a phrase at one place, but no whole window, are no candidates; near ones among them are."""
    r = random.Random(63)
    said = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    phrases = [said(13) for _ in range(40)]
    lines = [said(50) + phrases[k % 40] + said(120) for k in range(600)]
    near = [noisy(r, lines[k], 7) for k in range(0, 600, 20)]
    long = spark.createDataFrame(list(enumerate(lines + near)), "line_no long, line string").repartition(4)
    rows = linededup.meetings(linededup.packed_postings(long, 2, 4, 1, 0), 2, 10**6).collect()
    met = {(min(x["a"], x["b"]), max(x["a"], x["b"])) for x in rows if x["times"]}
    assert {(k, 600 + k // 20) for k in range(0, 600, 20)} <= met
    assert len(met) < 300
