"""Ranked lexical search over a length-stratified index.

A document's score for an item adds, for each of the item's terms, the term's
weight times an impact that depends on nothing but the term's count tf in the
document and the document's normaliser m (its length against the mean).  So
documents of equal m form a stratum: inside it a posting's impact depends on
tf alone and is computed once for each tf, and postings stand by term and tf,
the greatest tf last.

For each item and stratum, the weights times the impacts of the greatest tf
of each term bound every score in the stratum.  An item visits strata in the
order of their bounds.  It first scores those of the greatest bounds that hold
a few thousand documents; its k-th best score there is a floor, and of the
other strata it visits those whose bound reaches it.  Inside a stratum the
same test is made again for each tile.

A stratum may hold any share of the documents, so it is cut into tiles of some
hundred documents by a hash of the row.  Items travel in blocks of a bounded
number.  A task scores one block against one tile in vector steps, and passes
on at most k rows of each item.  Only terms that occur in an item are indexed;
the vocabulary is joined, and broadcast or not as Spark's size estimate says.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

TOP = 20
TILE = 512  # documents
BLOCK = 256  # items
SEED = 4096  # documents an item scores before it has a floor
WHOLE = b""  # stands for the document itself: its count is the number of its terms
_ASCII_TERM = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_FOLD = bytes(ord(" ") if c < 128 and c not in _ASCII_TERM else c + 32 if 65 <= c <= 90 else c for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def counted_terms(df: DataFrame) -> DataFrame:
    """(row, id, n, term, tf): each row's terms with their counts, and ``WHOLE`` with the number of all of them;
    rows without terms give none.  ``df`` has row, id and text."""
    kind = dict(df.dtypes)["id"]

    def count(batches):
        for batch in batches:
            row, terms, tf, of = batch["row"].to_numpy(), [], [], []
            n = np.zeros(len(batch), np.int64)
            for k, text in enumerate(batch["text"]):
                words = terms_of(text.as_py())
                if words:
                    c = Counter(words)
                    terms += [WHOLE, *c]
                    tf += [len(words), *c.values()]
                    of += [k] * (len(c) + 1)
                    n[k] = len(words)
                if len(terms) > 500_000 or k + 1 == len(batch):
                    at = np.array(of, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(row[at]), batch["id"].take(pa.array(at)), pa.array(n[at]), pa.array(terms, pa.binary()), pa.array(tf, pa.int64())],
                                                     ["row", "id", "n", "term", "tf"])
                    terms, tf, of = [], [], []

    return df.select("row", "id", "text").mapInArrow(count, f"row long, id {kind}, n long, term binary, tf long")


def _impact(tf, m):
    return F.expr(f"(1000000000L * {tf}) DIV (1000L * {tf} + 12L * {m})")


def score_tile(m: int, row: np.ndarray, term: np.ndarray, tf: np.ndarray, least: np.ndarray, sizes: np.ndarray, terms: np.ndarray, gains: np.ndarray):
    """(item, row, score) of all scores of a tile that reach the items' floors.

    Postings (row, term, tf) of documents with normaliser ``m``; the items'
    terms and gains lie one item after another, ``sizes`` of each."""
    order = np.lexsort((tf, term))
    term, tf, row = term[order], tf[order], row[order]
    rows, doc = np.unique(row, return_inverse=True)
    kinds, of = np.unique(tf, return_inverse=True)
    impact = (1_000_000_000 * kinds // (1000 * kinds + 12 * m))[of]  # once for each tf
    first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
    last = np.append(first[1:], len(term))
    item = np.repeat(np.arange(len(sizes)), sizes)
    at = np.minimum(np.searchsorted(term[first], terms), len(first) - 1)
    there = term[first][at] == terms
    item, at, gains = item[there], at[there], gains[there]
    bound = np.zeros(len(sizes), np.int64)
    np.add.at(bound, item, gains * impact[last[at] - 1])
    least = np.maximum(least, 1)
    alive = bound >= least
    keep = alive[item]
    item, at, gains = item[keep], at[keep], gains[keep]
    width = last[at] - first[at]
    # Items in slices of about a million postings.
    done = 0
    while done < len(item):
        upto = int(np.searchsorted(np.cumsum(width[done:]), 1_000_000)) + done + 1
        upto = int(np.searchsorted(item, item[min(upto, len(item)) - 1], side="right"))
        part = slice(done, upto)
        w, low = width[part], int(item[done])
        post = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(first[at[part]], w)
        score = np.zeros((int(item[upto - 1]) - low + 1) * len(rows), np.int64)
        np.add.at(score, np.repeat(item[part] - low, w) * len(rows) + doc[post], np.repeat(gains[part], w) * impact[post])
        found = np.flatnonzero(score >= np.repeat(least[low:int(item[upto - 1]) + 1], len(rows)))
        yield found // len(rows) + low, rows[found % len(rows)], score[found]
        done = upto


def _scored(index: DataFrame, visits: DataFrame, gains: DataFrame, top: int, scratch: Scratch, name: str) -> DataFrame:
    """(item, row, nameless, id, score): of each visit's tile the best ``top`` rows that reach the item's floor.

    ``visits``: item, m, least."""
    asked = visits.join(gains.groupBy("item").agg(F.collect_list("term_no").alias("terms"), F.collect_list("gain").alias("gains")), "item")
    block = F.floor(F.col("item_no") / BLOCK).cast("long")
    asked = (asked.groupBy("m", block.alias("block")).agg(F.collect_list(F.struct("item", "least", "terms", "gains")).alias("q"))
             .select("m", "block", F.col("q.item").alias("items"), F.col("q.least").alias("leasts"), F.transform("q.terms", F.size).alias("sizes"),
                     F.flatten("q.terms").alias("terms"), F.flatten("q.gains").alias("gains")))
    tiles = index.select("m", "tile").distinct()
    asked = scratch.write(tiles.join(asked, "m"), name)
    posted = index.join(visits.select("m", block.alias("block")).distinct(), "m")

    def best(key, postings: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"item": [], "row": [], "score": []}, dtype=np.int64)]
        if len(postings):
            named = postings.drop_duplicates("row").set_index("row")[["nameless", "id"]]
            for _, q in asked.iterrows():
                items = np.asarray(q["items"], np.int64)
                found = score_tile(int(key[0]), postings["row"].to_numpy(np.int64), postings["term_no"].to_numpy(np.int64), postings["tf"].to_numpy(np.int64),
                                   np.asarray(q["leasts"], np.int64), np.asarray(q["sizes"], np.int64), np.asarray(q["terms"], np.int64), np.asarray(q["gains"], np.int64))
                for item, row, score in found:
                    part = pd.DataFrame({"item": items[item], "row": row, "score": score}).join(named, on="row")
                    part = part.sort_values(["item", "score", "nameless", "id", "row"], ascending=[True, False, True, True, True])
                    out.append(part[part.groupby("item").cumcount() < top])
        out = pd.concat(out)
        for c, kind in (("nameless", bool), ("id", np.int64)):
            out[c] = out[c].astype(kind) if c in out else np.zeros(0, kind)
        return out[["item", "row", "nameless", "id", "score"]]

    keys = ["m", "tile", "block"]
    return posted.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(best, "item long, row long, nameless boolean, id long, score long")


def _ranked(scores: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "nameless", "id", "row")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def lexical_search(docs: DataFrame, items: DataFrame, top: int = TOP, tile: int = TILE, seed: int = SEED) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best rows of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text).

    Terms are runs of ASCII letters and digits and all characters beyond
    ASCII, A-Z lower-cased, of whole texts.  N counts the rows with a term, L
    all their terms, n one row's; m = 75 + (25 n N div L).  A term that df
    rows hold weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))); the score sums
    w ((10^9 tf) div (1000 tf + 12 m)) over the item's terms, repeats
    included.  Rows with a score above 0 are ranked, equal scores by doc_id.

    Null and termless texts are no documents, and find none as items.  Every
    row is a document of its own: repeated rows, or rows that share an id, each
    have a rank.  A null doc_id comes last among equal scores; an item with a
    null or repeated id is an item of its own.  An empty table on either side
    gives no rows; other columns are not looked at.  A very long text is one
    row's array of counts in one task.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    number = F.monotonically_increasing_id()
    asked = scratch.write(counted_terms(items.select(number.alias("row"), F.col("item_id").alias("id"), "text")), "items")
    asked = asked.where(F.col("term") != F.lit(WHOLE)).select(F.col("row").alias("item"), F.col("id").alias("item_id"), "term", "tf")
    vocabulary = asked.select("term").distinct().unionByName(spark.createDataFrame([(bytearray(WHOLE),)], "term binary"))
    vocabulary = scratch.write(vocabulary.withColumn("term_no", number), "vocabulary")
    named = docs.select(number.alias("row"), F.struct(F.col("doc_id").isNull().alias("nameless"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("doc_id")).alias("id"), "text")
    postings = counted_terms(named).join(vocabulary, "term").select("row", "id.nameless", F.col("id.doc_id").alias("id"), "n", "term_no", (F.col("term") == F.lit(WHOLE)).alias("whole"), "tf")
    postings = scratch.write(postings, "postings")

    total = postings.where("whole").agg(F.count(F.lit(1)).alias("N"), F.sum("tf").alias("L")).first()
    n_docs, n_terms = total["N"], total["L"] or 1
    stratum = F.expr(f"75L + (25L * n * {n_docs}L) DIV {n_terms}L").alias("m")
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0)))
    df = postings.where("NOT whole").groupBy("term_no").agg(F.count(F.lit(1)).alias("df"))
    gains = (asked.join(vocabulary, "term").join(df, "term_no").select("item", "term_no", (F.col("tf") * weight).cast("long").alias("gain")).where("gain > 0"))
    # Items by number, so a block has a bounded number of them.
    gains = scratch.write(gains, "gains")
    numbers = _numbered(gains.select("item").distinct(), scratch)

    strata = scratch.write(postings.where("whole").groupBy(stratum).agg(F.count(F.lit(1)).alias("docs")), "strata")
    index = (postings.where("NOT whole").select("row", "nameless", "id", stratum, "term_no", "tf").join(strata, "m")
             .withColumn("tile", F.pmod(F.xxhash64("row"), F.ceil(F.col("docs") / tile)))
             .select("m", "tile", "term_no", "tf", "row", "nameless", "id"))
    index = scratch.write(index.repartition("m", "tile").sortWithinPartitions("m", "tile", "term_no", "tf"), "index")
    scratch.drop("postings")

    greatest = index.groupBy("m", "term_no").agg(F.max("tf").alias("tf"))
    bounds = (greatest.select("m", "term_no", _impact("tf", "m").alias("impact")).join(gains, "term_no")
              .groupBy("item", "m").agg(F.sum(F.col("gain") * F.col("impact")).alias("bound")).join(strata, "m"))
    before = Window.partitionBy("item").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)
    bounds = bounds.withColumn("before", F.coalesce(F.sum("docs").over(before), F.lit(0)))
    bounds = scratch.write(bounds.join(numbers, "item").select("item", "item_no", "m", "bound", "before"), "bounds")
    visits = bounds.where(F.col("before") < seed).select("item", "item_no", "m", F.lit(1).cast("long").alias("least"))
    found = scratch.write(_ranked(_scored(index, visits, gains, top, scratch, "asked-first"), top).drop("rank"), "found")
    floor = found.groupBy("item").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") == top).select("item", "least")
    visits = bounds.where(F.col("before") >= seed).join(floor, "item", "left").withColumn("least", F.coalesce("least", F.lit(1).cast("long")))
    visits = scratch.write(visits.where("bound >= least").select("item", "item_no", "m", "least"), "visits")
    more = _scored(index, visits, gains, top, scratch, "asked-more")
    best = _ranked(found.unionByName(more), top)
    ids = asked.select("item", "item_id").distinct()
    doc_id = F.when(~F.col("nameless"), F.col("id")).cast(dict(docs.dtypes)["doc_id"])
    return best.join(ids, "item").select("item_id", F.col("rank").cast("int").alias("rank"), doc_id.alias("doc_id"), "score")


def _numbered(items: DataFrame, scratch: Scratch) -> DataFrame:
    """(item, item_no): items numbered from 0, by partition and place."""
    placed = scratch.write(items.orderBy("item").select("item", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)).alias("place")), "numbers")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offset = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    return placed.join(offset, "part").select("item", (F.col("off") + F.col("place")).alias("item_no"))
