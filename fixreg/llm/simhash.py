"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits; two texts are linked when theirs differ in
``distance`` (4) bits or fewer.  The 64 bits are cut into blocks of 23, 23 and
18 bits.  Bits that differ fall into the blocks, so of two linked fingerprints
one block differs little: by at most 1 bit in the first, or 1 in the second,
or 0 in the third (2 + 2 + 1 > 4).  Each block has a covering code:

* 23 bits: the perfect Golay code, 4,096 anchors, covering radius 3;
* 18 bits: every word is an anchor, covering radius 0.

A fingerprint is at home at the anchor of its block, and is also sent to every
anchor within covering radius plus the block's share of the threshold (3 + 1,
0 + 0).  If block i of x and y differ by the share or less, y reaches x's home
anchor.  Per anchor, homes are compared with all that were sent there, over
all 64 bits.  That costs 1 + 2 * 5.3 rows for a fingerprint, whatever the data.

Only distinct fingerprints are sent, so copies cost nothing.  Cells are cut
into tiles of bounded size by a count of each anchor's rows (a table of at
most 2 * 4,096 + 262,144 rows); a hot anchor becomes many tiles.  A tile
returns a spanning forest of its links, not all pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, fresh, runs, text_udf, written
from .decontaminate import row_key

SHINGLE = 4
DISTANCE = 4
TILE = 4096


def fingerprints(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints (uint64) of texts.

    Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; shingles
    of ``shingle`` words joined by a space, repeats included; fewer words make
    one shingle, none make fingerprint zero.
    """
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        n = max(1, len(words) - shingle + 1)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
        ends = (ends[-n:] - 1).tolist()
        h = np.fromiter([digest(joined[a:b], 42) for a, b in zip(starts, ends)], np.uint64, n)
        ones = np.zeros(64, np.int64)
        for a in range(0, n, 65536):
            ones += np.unpackbits(h[a:a + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        bits = (2 * ones > n).astype(np.uint8)
        out[i] = np.packbits(bits, bitorder="little").view(np.uint64)[0]
    return out


def golay_anchors() -> np.ndarray:
    """The 4,096 words of the binary Golay code of length 23, by its generator polynomial."""
    generator = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
    words = np.zeros(4096, np.uint32)
    for k in range(12):
        words ^= np.where(np.arange(4096) >> k & 1, generator << k, 0).astype(np.uint32)
    return words


def golay_near(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """By syndrome (11 bits): the error patterns of up to ``radius`` bits, flat, with offsets.

    The anchors within ``radius`` of a word are the word with each error
    pattern of its syndrome taken off.
    """
    generator = 0b101011100011
    check = np.zeros(23, np.uint32)
    for i in range(23):
        r = 1 << i
        for k in range(22, 10, -1):
            if r >> k & 1:
                r ^= generator << (k - 11)
        check[i] = r
    patterns, marks = [np.zeros(1, np.uint32)], [np.zeros(1, np.uint32)]
    last = [(np.uint32(0), np.uint32(0), -1)]
    for _ in range(radius):
        last = [(p | np.uint32(1 << i), s ^ check[i], i) for p, s, top in last for i in range(top + 1, 23)]
        patterns.append(np.array([p for p, _, _ in last], np.uint32))
        marks.append(np.array([s for _, s, _ in last], np.uint32))
    pattern, mark = np.concatenate(patterns), np.concatenate(marks)
    order = np.argsort(mark, kind="stable")
    return pattern[order], np.searchsorted(mark[order], np.arange(2049))


def golay_syndrome(words: np.ndarray) -> np.ndarray:
    generator = 0b101011100011
    rest = words.astype(np.uint32)
    for k in range(22, 10, -1):
        rest = np.where(rest >> np.uint32(k) & np.uint32(1), rest ^ np.uint32(generator << (k - 11)), rest)
    return rest


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) of the anchors each fingerprint goes to.

    The anchor carries its block above bit 23.  Of a 23-bit block, the home
    is the one anchor within 3 bits.
    """
    pattern, at = golay_near(4)
    weight = np.bitwise_count(pattern)
    rows, cells, homes = [], [], []
    for block, shift in ((0, 0), (1, 23)):
        word = (prints >> np.uint64(shift) & np.uint64(2**23 - 1)).astype(np.uint32)
        mark = golay_syndrome(word)
        n = at[mark + 1] - at[mark]
        row = np.repeat(np.arange(len(prints)), n)
        pick = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[mark], n)
        rows.append(row)
        cells.append((word[row] ^ pattern[pick]).astype(np.int64) | block << 23)
        homes.append(weight[pick] <= 3)
    rows.append(np.arange(len(prints)))
    cells.append((prints >> np.uint64(46)).astype(np.int64) | 2 << 23)
    homes.append(np.ones(len(prints), bool))
    return np.concatenate(rows), np.concatenate(cells), np.concatenate(homes)


def forest(x: np.ndarray, y: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the graph between homes ``x`` and sent ``y`` (uint64).

    Breadth first: each step compares the new members with what is still
    unreached, in slices, so no more than a slice of the pairs exists at once.
    """
    if len(x) * len(y) <= 1_000_000 and not ((np.bitwise_count(x[:, None] ^ y) <= distance) & (x[:, None] != y)).any():
        return x[:0], x[:0]  # the usual tile: no links
    left, found_a, found_b = np.ones(len(y), bool), [], []
    free = np.ones(len(x), bool)
    for seed in range(len(x)):
        if not free[seed]:
            continue
        free[seed] = False
        new = x[seed:seed + 1]
        while len(new):
            rest = np.flatnonzero(left)
            hit, by = _reached(y[rest], new, distance)
            rest = rest[hit]
            left[rest] = False
            found_a.append(by)
            found_b.append(y[rest])
            new = y[rest]
            if not len(new):
                break
            rest = np.flatnonzero(free)
            hit, by = _reached(x[rest], new, distance)
            rest = rest[hit]
            free[rest] = False
            found_a.append(by)
            found_b.append(x[rest])
            new = x[rest]
    if not found_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    return a[a != b], b[a != b]


def _reached(rest: np.ndarray, new: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``rest`` within ``distance`` of some of ``new``, and one such of each."""
    hits, by, open_ = [], [], np.arange(len(rest))
    step = max(1, 1_000_000 // max(1, len(rest)))
    for a in range(0, len(new), step):
        if not len(open_):
            break
        near = np.bitwise_count(rest[open_][:, None] ^ new[None, a:a + step]) <= distance
        got = near.any(1)
        hits.append(open_[got])
        by.append(new[a + near[got].argmax(1)])
        open_ = open_[~got]
    if not hits:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(hits), np.concatenate(by)


def links(prints: DataFrame, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """Spanning links (a, b) among the distinct fingerprints (column ``fp``, long)."""
    if distance > 4:
        raise ValueError("the blocks' shares cover up to 4 bits")

    def send(batches):
        for pdf in batches:
            fp = pdf["fp"].to_numpy(np.int64)
            for a in range(0, len(fp), 20000):
                part = fp[a:a + 20000]
                row, cell, home = anchors(part.view(np.uint64))
                yield pd.DataFrame({"cell": cell.astype(np.int32), "fp": part[row], "home": home})

    sent = written(prints.select("fp").mapInPandas(send, "cell int, fp long, home boolean"), "simhash-sent")
    # Rows by anchor: at most the number of anchors, whatever the input.
    size = sent.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_if("home").alias("n_home")).where("n > 1 AND n_home > 0")
    size = size.select("cell", F.ceil(F.col("n") / tile).cast("int").alias("ks"), F.ceil(F.col("n_home") / tile).cast("int").alias("kh"))
    rows = sent.join(size, "cell")
    salt = F.xxhash64("fp", F.lit(7))
    homes = rows.where("home").select("cell", "fp", F.lit(True).alias("home"), F.pmod(salt, "kh").cast("int").alias("i"),
                                      F.explode(F.sequence(F.lit(0), F.col("ks") - 1)).alias("j"))
    others = rows.select("cell", "fp", F.lit(False).alias("home"), F.explode(F.sequence(F.lit(0), F.col("kh") - 1)).alias("i"),
                         F.pmod(salt, "ks").cast("int").alias("j"))

    def compare(batches):
        for tile_rows in runs(batches, ["cell", "i", "j"]):
            fp, home = tile_rows["fp"].to_numpy(np.int64).view(np.uint64), tile_rows["home"].to_numpy(bool)
            a, b = forest(fp[home], fp[~home], distance)
            if len(a):
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    tiles = homes.unionByName(others).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return tiles.mapInPandas(compare, "a long, b long")


def print_column(text: Column, shingle: int = SHINGLE) -> Column:
    of = text_udf(lambda: lambda texts: {"fp": fingerprints(texts, shingle).view(np.int64)}, "fp long")
    return of(text).getField("fp")


def print_components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``prints`` (one row for each fingerprint ``fp``) with the ``component`` each belongs to."""
    comp = connected_components(links(prints, distance)).withColumnRenamed("node", "fp")
    return prints.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable over links of
    ``distance`` bits or fewer.  A null or blank text has fingerprint zero and
    is linked like any other; repeated rows are returned as often as they
    come; a null doc_id is never a component's name unless it has no other
    (then the name is null).  An empty table gives an empty result, other
    columns are not looked at.  Of a very long text a task holds the words and
    their hashes at once, some 60 bytes a word.
    """
    fp = written(docs.select("doc_id", print_column(F.col("text"), shingle).alias("fp")), "simhash-prints")
    linked = written(print_components(fp.groupBy("fp").agg(F.min("doc_id").alias("low")), distance), "simhash-linked")
    names = written(linked.groupBy("component").agg(F.min("low").alias("component_id")), "simhash-names")
    # Written tables on either side: the skew split deals a large component's rows to many tasks.
    of_print = written(linked.select("fp", "component").join(names, "component").select("fp", "component_id"), "simhash-named")
    return fp.join(of_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each SimHash group: that of the smallest
    doc_id, a null id only if the group has no other.  Of rows that share this
    id one stays, by a hash of their texts."""
    k1, k2 = fresh(docs, "k1"), fresh(docs, "k2")
    rows = row_key(docs.select("doc_id", "text")).select("doc_id", "k1", "k2", print_column(F.col("text")).alias("fp"))
    least = F.struct(F.isnull("doc_id").alias("null"), "doc_id", "k1", "k2")
    prints = written(rows.select("fp", least.alias("row")), "simhash-rows").groupBy("fp").agg(F.min("row").alias("row"))
    keep = print_components(prints).groupBy("component").agg(F.min("row").alias("row")).select(F.col("row.k1").alias(k1), F.col("row.k2").alias(k2))
    keyed = docs.withColumns({k1: F.xxhash64(F.lit(1), "doc_id", "text"), k2: F.xxhash64(F.lit(2), "doc_id", "text")})
    return keyed.join(keep, [k1, k2], "left_semi").dropDuplicates([k1, k2]).select(*docs.columns)
