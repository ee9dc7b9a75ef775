"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions alone.

An item's windows are its runs of 13 words.  A window occurs in a document
only if all its words do, so one necessary word is enough to find it: words
are ordered by how often they occur in all documents, and the rarest word of a
window, with its offset, is its prefix.  Each document word is joined with the
prefixes; a hit at position p proposes the window at p - offset.  Proposals
must fit into the document (positional and length bound) and are verified word
by word.

The documents' words are written once to the scratch folder and read for the
counts and for the join.  The prefixes are broadcast only while they are few
(``BROADCAST_ROWS``, checked by a count); beyond it they are joined by a
shuffle of (row, position, word hash), and the words of the proposed documents
are joined afterwards.  Both ways give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, written

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NGRAM = 13
BROADCAST_ROWS = 100_000


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, joined by a space ('' if none)."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN, " "))


def row_key(df: DataFrame) -> DataFrame:
    """``df`` with k1, k2: 128 bits that only repeated rows (equal doc_id and text) share."""
    return df.withColumns({"k1": F.xxhash64(F.lit(1), "doc_id", "text"), "k2": F.xxhash64(F.lit(2), "doc_id", "text")})


def windows_of(items: DataFrame, ngram: int) -> DataFrame:
    """(window, words, size, item_id): each item's windows of ``ngram`` words; a shorter item is one window."""
    w = items.select("item_id", words_of(F.col("text")).alias("w")).where("w <> ''").withColumn("w", F.split("w", " "))
    last = F.greatest(F.size("w") - ngram, F.lit(0))
    w = w.select("item_id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("w", i + 1, ngram))).alias("words"))
    return w.select(F.sha2(F.array_join("words", " "), 256).alias("window"), "words", F.size("words").alias("size"), "item_id").distinct()


def occurrences(words: DataFrame, windows: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(k1, k2, start, size, window): where windows occur in ``words`` (k1, k2, n_words, words: space-joined)."""
    tokens = words.where("n_words > 0").select("k1", "k2", "n_words", F.split("words", " ").alias("w"))
    at = tokens.select("k1", "k2", "n_words", "w", F.posexplode("w").alias("pos", "word")).withColumn("token", F.xxhash64("word"))

    distinct = windows.groupBy("window").agg(F.first("words").alias("item_words"), F.first("size").alias("size"))
    flat = distinct.select("window", F.posexplode("item_words").alias("offset", "word")).withColumn("token", F.xxhash64("word"))
    vocabulary = written(flat.select("token").distinct(), "decontaminate-vocabulary")
    few = vocabulary.count() <= broadcast_rows
    count = (at.select("token").join(F.broadcast(vocabulary) if few else vocabulary, "token", "left_semi")
             .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    # Written, so that in the join below the skew split deals a token of very many windows to many tasks.
    rarity = written(vocabulary.join(count, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n")), "decontaminate-rarity")
    flat = written(flat, "decontaminate-flat")
    prefix = (flat.join(rarity, "token").groupBy("window")
              .agg(F.min(F.struct("n", "token", "offset")).alias("rarest")).where("rarest.n > 0")
              .select("window", "rarest.token", "rarest.offset")
              .join(distinct, "window"))
    prefix = written(prefix, "decontaminate-prefix")

    fits = "pos >= offset AND pos - offset + size <= n_words"
    same = "slice(w, start + 1, size) = item_words"
    start = (F.col("pos") - F.col("offset")).alias("start")
    if prefix.count() <= broadcast_rows:
        return (at.join(F.broadcast(prefix), "token").where(fits)
                .select("k1", "k2", start, "size", "window", "w", "item_words").where(same)
                .select("k1", "k2", "start", "size", "window"))
    proposed = (at.drop("w").join(prefix.select("window", "token", "offset", "size"), "token").where(fits)
                .select("k1", "k2", start, "size", "window").distinct())
    return (proposed.join(tokens.select("k1", "k2", "w").dropDuplicates(["k1", "k2"]), ["k1", "k2"])
            .join(prefix.select("window", "item_words"), "window").where(same)
            .select("k1", "k2", "start", "size", "window"))


def _judged(docs: DataFrame, items: DataFrame, ngram: int = NGRAM, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``contamination`` with each row's key."""
    base = row_key(docs.select("doc_id", "text"))
    base = base.select("doc_id", "k1", "k2", words_of(F.col("text")).alias("words"))
    n_words = F.when(F.col("words") == "", 0).otherwise(F.length("words") - F.length(F.replace("words", F.lit(" "))) + 1)
    words = written(base.withColumn("n_words", n_words.cast("long")), "decontaminate-words")
    windows = written(windows_of(items.select("item_id", "text"), ngram), "decontaminate-windows")
    found = written(occurrences(words, windows, broadcast_rows), "decontaminate-found")

    # The union's length: spans by start, each adding what lies beyond the furthest end so far.
    spans = found.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("spans"))
    n_hit = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
                        lambda a, s: F.struct((a["n"] + F.greatest(s["end"] - F.greatest(a["upto"], s["start"].cast("long")), F.lit(0))).alias("n"),
                                              F.greatest(a["upto"], s["end"].cast("long")).alias("upto")), lambda a: a["n"])
    spans = spans.select("k1", "k2", n_hit.alias("n_hit"))
    named = (found.select("k1", "k2", "window").distinct().join(windows.select("window", "item_id"), "window")
             .groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    out = (words.select("doc_id", "k1", "k2", "n_words").join(spans.join(named, ["k1", "k2"]), ["k1", "k2"], "left"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "k1", "k2", "n_words", n_hit.alias("n_hit"),
                      F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
                      F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                      ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def contamination(docs: DataFrame, items: DataFrame, ngram: int = NGRAM, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text) against ``items`` (item_id, text).

    doc_id, n_words, n_hit (words inside an occurrence of a window), n_items
    (items with an occurring window), items_sha256 (their ids, sorted as
    strings, comma-joined), contaminated (n_hit > 0 and 20 n_hit >= n_words).

    Null or wordless texts have no words and are clean; items without words
    have no windows; an empty table on either side leaves every document
    clean.  Items with a null id hit words but are not counted or named.
    Repeated rows are returned as often as they come; other columns are not
    looked at.  A very long text's words are one row's array.
    """
    return _judged(docs, items, ngram, broadcast_rows).drop("k1", "k2")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows.  Few are, so those are joined away."""
    names = [fresh(docs, n) for n in ("k1", "k2")]
    keyed = docs.withColumns({n: F.xxhash64(F.lit(i), "doc_id", "text") for i, n in enumerate(names, 1)})
    bad = _judged(docs, items).where("contaminated").select(F.col("k1").alias(names[0]), F.col("k2").alias(names[1])).distinct()
    return keyed.join(bad, names, "left_anti").select(*docs.columns)
