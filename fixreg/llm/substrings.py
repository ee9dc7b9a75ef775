"""Substring dedup: passages of 20 words or more that were said before.

A window is a run of 20 words of one text.  Its Rabin-Karp hash rolls along
the text: from the prefix sums of the words' hashes, every window has its hash
in a few vector steps, however long the window is.  Hashes are counted in
Spark; a window that is not the first of its hash is repeated, and the
repeated windows of a text merge into maximal intervals, whose words go.

Counting every window would shuffle several times the input.  So the windows
are first screened by their least gram: of the 14 runs of 7 words inside a
window, the one with the least hash.  Equal windows have equal least grams,
and neighbouring windows mostly share theirs, so there is one gram for seven
words.  Grams are counted over all texts; only windows whose least gram occurs
at a second place can repeat, and only those are counted.  Both counts are
partial aggregates, and what follows them are joins that leave a hot gram or
a hot window to the skew split.

Texts that are equal as a whole are one text, at the place of the first; of
the others every window was said before.  The order of the texts is a number
in the sorted order of (doc_id, digest), nulls first.  Hashes have 128 bits
where they stand for windows or texts, 64 where they only screen.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, chunks

WINDOW = 20
GRAM = 7
# Odd multipliers of the rolling hashes: of a gram, and of both halves of a window's hash.
GRAM_BASE, BASES = 0x9E3779B97F4A7C15, (0xD1342543DE82EF95, 0x2545F4914F6CDD1D)


def words_of(text: str) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return text.encode("utf-8", "surrogatepass").split()


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, and where each text begins (one entry more)."""
    words = [words_of(t) for t in texts]
    start = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for ws in words for w in ws), np.uint64, int(start[-1])), start


def rolling(x: np.ndarray, n: int, base: int) -> np.ndarray:
    """Rabin-Karp hash, modulo 2^64, of every ``n`` consecutive values."""
    if len(x) < n:
        return np.zeros(0, np.uint64)
    up = np.multiply.accumulate(np.concatenate((np.array([pow(base, n - 1, 2**64)], np.uint64), np.full(len(x) - n, base, np.uint64))))
    down = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(x) - 1, pow(base, -1, 2**64), np.uint64))))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * down, dtype=np.uint64)))
    return (total[n:] - total[:-n]) * up


def least_grams(x: np.ndarray, text: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hashes, the least one inside each window, whether the window lies in one text)."""
    h = rolling(x, gram, GRAM_BASE)
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    n = len(x) - window + 1
    least = h[:n].copy()
    for k in range(1, window - gram + 1):
        np.minimum(least, h[k:k + n], out=least)
    return h, least, text[:n] == text[window - 1:]


def _grams(texts: list[str], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, gram, twice): the least grams of each text's windows, each once; ``twice`` if it stands at two places of the text."""
    x, start = word_hashes(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(start))
    if len(x) < window:
        return text[:0], x[:0], x[:0] > 0
    h, least, whole = least_grams(x, text, window, gram)
    chosen = np.zeros(len(h), bool)
    for k in range(window - gram + 1):
        chosen[k:k + len(least)] |= whole & (least == h[k:k + len(least)])
    at = np.flatnonzero(chosen)
    row, value = text[at], h[at]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])))) if len(row) else np.zeros(0, np.int64)
    return row[new], value[new], np.diff(np.append(new, len(row))) > 1


def _windows(texts: list[str], wanted: list[np.ndarray], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, two hashes) of the windows whose least gram is ``wanted`` in their text."""
    x, start = word_hashes(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(start))
    if len(x) < window:
        return text[:0], text[:0], x[:0], x[:0]
    _, least, whole = least_grams(x, text, window, gram)
    keep = np.zeros(len(least), bool)
    for i, some in enumerate(wanted):
        a, b = start[i], max(start[i], start[i + 1] - window + 1)
        keep[a:b] = np.isin(least[a:b], some)
    at = np.flatnonzero(keep & whole)
    return text[at], at - start[text[at]], *(rolling(x, window, b)[at] for b in BASES)


def _text_order(docs: DataFrame) -> DataFrame:
    """(h1, h2, first, text_no) by distinct text: its first doc_id, and its number in the order of the texts."""
    texts = docs.groupBy("h1", "h2").agg(F.min(F.struct("doc_id")).alias("first"))
    return texts.orderBy(F.col("first.doc_id").asc_nulls_first(), "h1", "h2").withColumn("text_no", F.monotonically_increasing_id())


def repeated_starts(texts: DataFrame, scratch: Scratch, window: int, gram: int) -> DataFrame:
    """(text_no, starts): the starts of the windows of ``texts`` (text_no, text) that also start earlier.  ``texts`` is the
    table of that name in ``scratch``, and goes."""

    def grams(batches):
        for batch in batches:
            said, number = batch["text"].to_pylist(), batch["text_no"].to_numpy()
            for a, b in chunks(said):
                row, value, twice = _grams(said[a:b], window, gram)
                yield pa.RecordBatch.from_arrays([pa.array(number[a:b][row]), pa.array(value.view(np.int64)), pa.array(twice)], ["text_no", "gram", "twice"])

    def hashes(batches):
        for batch in batches:
            said, number = batch["text"].to_pylist(), batch["text_no"].to_numpy()
            wanted = [np.asarray(w, np.int64).view(np.uint64) for w in batch["wanted"].to_numpy(zero_copy_only=False)]
            for a, b in chunks(said):
                row, place, h1, h2 = _windows(said[a:b], wanted[a:b], window, gram)
                yield pa.RecordBatch.from_arrays([pa.array(number[a:b][row]), pa.array(place.astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], ["text_no", "place", "w1", "w2"])

    screened = scratch.write(texts.select("text_no", "text").mapInArrow(grams, "text_no long, gram long, twice boolean"), "grams")
    often = screened.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice")).where("n > 1 OR twice").select("gram")
    often = scratch.write(often, "often")  # a written table on either side lets the skew split deal out a hot gram
    wanted = scratch.write(screened.join(often, "gram", "left_semi").groupBy("text_no").agg(F.collect_list("gram").alias("wanted")), "wanted")
    scratch.drop("grams", "often")
    windows = texts.join(wanted, "text_no").select("text_no", "text", "wanted").mapInArrow(hashes, "text_no long, place int, w1 long, w2 long")
    windows = scratch.write(windows, "windows")
    scratch.drop("wanted", "texts")
    first = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("text_no", "place")).alias("first")).where("n > 1").select("w1", "w2", "first")
    first = scratch.write(first, "first")
    again = windows.join(first, ["w1", "w2"]).where("text_no <> first.text_no OR place <> first.place")
    starts = scratch.write(again.groupBy("text_no").agg(F.sort_array(F.collect_list("place")).alias("starts")), "starts")
    scratch.drop("windows", "first")
    return starts


def merged(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals (start, end) of words that windows at the sorted ``starts`` cover; those that touch are one."""
    new = np.concatenate(([True], starts[1:] > starts[:-1] + window))
    return starts[new], starts[np.append(new[1:], True)] + window


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, spans, kept) for each row of ``docs`` (doc_id, text).

    Words are ``[^\\x20\\x09-\\x0D]+``.  A word goes if it lies in a run of
    ``window`` words that also starts earlier: at a smaller doc_id, or earlier
    in the same document.  ``spans`` are the maximal removed intervals of word
    numbers (start, end exclusive), ``kept`` the words that stay, joined by
    one space.  Windows are those of the input, not of what is left.

    A null text has no words; texts of fewer than ``window`` words lose none.
    A null doc_id comes before all others; different texts of one doc_id come
    in the order of their digests.  Repeated rows (equal doc_id and text) are
    one document given more than once and get the same result.  An empty table
    gives no rows; other columns are not looked at.  A very long text is held
    by one task, at about 60 bytes a word.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumns({"h1": F.xxhash64(F.lit(1), "text"), "h2": F.xxhash64(F.lit(2), "text")})
    enough = keyed.where(F.length("text") >= 2 * window - 1)  # fewer characters can't hold a window
    order = scratch.write(_text_order(enough), "order")
    texts = enough.groupBy("h1", "h2").agg(F.first("text").alias("text")).join(order.select("h1", "h2", "text_no"), ["h1", "h2"])
    starts = repeated_starts(scratch.write(texts.select("text_no", "text"), "texts"), scratch, window, gram)

    @F.pandas_udf("n_words long, begins array<int>, ends array<int>, kept string")
    def cut(text: pd.Series, copy: pd.Series, starts: pd.Series) -> pd.DataFrame:
        rows = []
        for said, again, some in zip(text, copy, starts):
            words = words_of(said)
            a, b = np.zeros(0, np.int32), np.zeros(0, np.int32)
            if again and len(words) >= window:
                a, b = np.array([0], np.int32), np.array([len(words)], np.int32)
            elif some is not None and len(some):
                a, b = merged(np.asarray(some, np.int32), window)
            at, left = 0, []
            for x, y in zip(a.tolist(), b.tolist()):
                left += words[at:x]
                at = y
            rows.append((len(words), a, b, b" ".join(left + words[at:]).decode("utf-8", "surrogatepass")))
        return pd.DataFrame(rows, columns=["n_words", "begins", "ends", "kept"])

    known = order.join(starts, "text_no", "left").select("h1", "h2", "first", "starts")
    out = keyed.join(known, ["h1", "h2"], "left")
    copy = F.col("first").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    out = out.select("doc_id", cut("text", copy, "starts").alias("cut"))
    spans = F.arrays_zip(F.col("cut.begins").alias("start"), F.col("cut.ends").alias("end"))
    return out.select("doc_id", "cut.n_words", spans.alias("spans"), "cut.kept")


def digests(passages: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of ``repeated_passages``."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return passages.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
