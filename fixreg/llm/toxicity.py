"""Toxicity scores by a bidirectional gated recurrent network with attention pooling.

A text's words go through the network in overlapping windows of 48 words, 40
apart; all windows are scored and the highest counts.  A word's input joins an
embedding of the word and one of its characters (its beginnings of 3 to 6
characters and its last 3), both in hashed tables.  Everything is trained in
numpy on a bounded sample of labelled rows.  The first input of either table
is the log odds of its bucket in the sample; while the network learns, a text
sees the odds of the other folds' texts, so it can't learn its own rare words.
The tables' other inputs are fixed random codes.  The network is learned from
windows: of a toxic text the one that scores highest
so far, of a clean text that one or a random one.  Gates and states use x / (1 + |x|) in place of the hyperbolic
tangent, which costs a fifth of it.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, hand_back, text_udf

WORD = re.compile(r"[^\W_]+")
WIDTH, STRIDE = 48, 40
WORD_BUCKETS, CHAR_BUCKETS = 1 << 18, 1 << 17
EACH = 4  # inputs from either table
HIDDEN, ATTEND = 8, 8
THRESHOLD = 0.7


def buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each word's bucket, and those of its characters (5 columns; -1: the word is too short)."""
    head = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_BUCKETS for w in words], np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    first = np.cumsum(size) - size
    out, h = [], np.zeros(len(words), np.uint64)
    place = lambda h, salt: ((h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) >> np.uint64(40)).astype(np.int64) % CHAR_BUCKETS
    for k in range(6):
        at = np.minimum(first + k, max(0, len(code) - 1))
        h = h * np.uint64(1_000_003) + code[at] if len(code) else h
        if k >= 2:
            out.append(np.where(size > k, place(h, k), -1))
    h = np.zeros(len(words), np.uint64)
    for k in (3, 2, 1):
        h = h * np.uint64(1_000_003) + code[np.maximum(first + size - k, 0)] if len(code) else h
    out.append(place(h, 99))
    return head, np.stack(out, axis=1).reshape(len(words), 5)


def windows(n: int) -> list[tuple[int, int]]:
    """Ranges of all windows over n words; the last reaches the end."""
    return [(a, min(n, a + WIDTH)) for a in range(0, max(1, n - WIDTH + STRIDE), STRIDE)] if n else []


def squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def slope(y: np.ndarray) -> np.ndarray:
    """Derivative of ``squash`` where it is y."""
    return (1 - np.abs(y)) ** 2


def gate(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * squash(x)


def gate_slope(y: np.ndarray) -> np.ndarray:
    return 0.5 * slope(2 * y - 1)


def chance(logit):
    return 0.5 * np.tanh(0.5 * np.asarray(logit, np.float64)) + 0.5


class Network:
    """Weights, the forward pass, and its gradient."""

    def __init__(self, seed: int = 1):
        r = np.random.default_rng(seed)
        small = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        d = 2 * EACH
        self.w = {"word": (0.1 * r.standard_normal((WORD_BUCKETS, EACH))).astype(np.float32), "char": (0.1 * r.standard_normal((CHAR_BUCKETS, EACH))).astype(np.float32)}
        for way in ("f", "b"):
            self.w |= {f"x{way}": small(d, 3 * HIDDEN), f"u{way}": small(HIDDEN, 3 * HIDDEN), f"c{way}": np.zeros(3 * HIDDEN, np.float32)}
        self.w |= {"a": small(2 * HIDDEN, ATTEND), "a0": np.zeros(ATTEND, np.float32), "v": small(ATTEND), "o": small(2 * HIDDEN), "o0": np.zeros(1, np.float32)}
        self.trained = False

    def inputs(self, head: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Input vectors of words by their buckets."""
        there = chars >= 0
        own = (self.w["char"][chars] * there[:, :, None]).sum(1) / there.sum(1)[:, None]
        return np.concatenate((self.w["word"][head], own), axis=1).astype(np.float32)

    def run(self, take, mask: np.ndarray, keep: bool = False):
        """Logits of windows: ``take(way, i)`` has the projected inputs of word i of each; mask (T, n)."""
        t, n = mask.shape
        kind = self.w["o"].dtype
        states, steps = np.empty((t, n, 2 * HIDDEN), kind), []
        full = mask.all(1)
        for way in (0, 1):
            h, u = np.zeros((n, HIDDEN), kind), self.w["u" + "fb"[way]]
            for i in range(t) if way == 0 else range(t - 1, -1, -1):
                p, q = take(way, i), h @ u
                zr = gate(p[:, :2 * HIDDEN] + q[:, :2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                new = squash(p[:, 2 * HIDDEN:] + r * q[:, 2 * HIDDEN:])
                step = (1 - z) * (new - h)
                if not full[i]:
                    step *= mask[i][:, None]
                if keep:
                    steps.append((way, i, h, q, z, r, new))
                h = h + step
                states[i, :, way * HIDDEN:(way + 1) * HIDDEN] = h
        look = squash(states.reshape(t * n, -1) @ self.w["a"] + self.w["a0"])
        weight = np.where(mask > 0, (look @ self.w["v"]).reshape(t, n), -1e9)
        weight = np.exp(weight - weight.max(0)) * mask
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tn,tns->ns", weight, states)
        logit = pooled @ self.w["o"] + self.w["o0"]
        return (logit, states, look.reshape(t, n, -1), weight, pooled, steps) if keep else logit

    def project(self, x: np.ndarray) -> list[np.ndarray]:
        """What either direction takes from input vectors."""
        return [x @ self.w["x" + name] + self.w["c" + name] for name in "fb"]

    def gradient(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray):
        """Gradients of the mean log loss by weight, and by input vector (T, n, d)."""
        t, n = mask.shape
        p = self.project(x)
        logit, states, look, weight, pooled, steps = self.run(lambda way, i: p[way][i], mask, keep=True)
        g = {k: np.zeros_like(v) for k, v in self.w.items() if k not in ("word", "char")}
        err = ((chance(logit) - label) / n).astype(x.dtype)
        g["o"], g["o0"][0] = pooled.T @ err, err.sum()
        d_pool = err[:, None] * self.w["o"]
        d_weight = (states * d_pool).sum(2)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        g["v"] = np.einsum("tnk,tn->k", look, d_score)
        d_look = d_score[:, :, None] * self.w["v"] * slope(look)
        g["a"], g["a0"] = np.einsum("tns,tnk->sk", states, d_look), d_look.sum((0, 1))
        d_state = weight[:, :, None] * d_pool + d_look @ self.w["a"].T
        d_x = np.zeros_like(x)
        back = [np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)]
        for way, i, h, q, z, r, new in reversed(steps):
            name, m = "fb"[way], mask[i][:, None]
            u = self.w["u" + name]
            dh = d_state[i, :, way * HIDDEN:(way + 1) * HIDDEN] + back[way]
            step = m * dh
            d_new = step * (1 - z) * slope(new)
            d_z = -step * (new - h) * gate_slope(z)
            d_r = d_new * q[:, 2 * HIDDEN:] * gate_slope(r)
            d_p = np.concatenate((d_z, d_r, d_new), axis=1)
            d_q = np.concatenate((d_z, d_r, d_new * r), axis=1)
            g["u" + name] += h.T @ d_q
            g["x" + name] += x[i].T @ d_p
            g["c" + name] += d_p.sum(0)
            d_x[i] += d_p @ self.w["x" + name].T
            back[way] = dh * (1 - m * (1 - z)) + d_q @ u.T
        return g, d_x, float(np.mean(np.logaddexp(0, logit) - label * logit))


class Words:
    """Projected inputs of known words, kept between texts up to a bound."""

    def __init__(self, network: Network, most: int = 100_000):
        self.network, self.most = network, most
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.table = [np.zeros((0, 3 * HIDDEN), np.float32)] * 2

    def of(self, words: list[list[str]]) -> list[np.ndarray]:
        """Places of the words of some texts; new words are projected."""
        if len(self.place) > self.most:
            self.clear()
        new = list(set().union(*words).difference(self.place))
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            more = self.network.project(self.network.inputs(*buckets(new)))
            self.table = [np.concatenate(x) for x in zip(self.table, more)]
        return [np.array([self.place[w] for w in ws], np.int64) for ws in words]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Scorer:
    """Scores whole texts: the highest of their windows; a text without words gets the network's bias."""

    def __init__(self, network: Network):
        self.network, self.words = network, Words(network)

    def window_logits(self, places: list[np.ndarray], table: list[np.ndarray]) -> list[np.ndarray]:
        """Logits of all windows of texts, given as places in ``table``."""
        ranges = [windows(len(p)) for p in places]
        flat = np.concatenate([*places, np.zeros(1, np.int64)])
        base = np.cumsum([0, *map(len, places)])
        start = np.array([base[k] + a for k, r in enumerate(ranges) for a, _ in r], np.int64)
        size = np.array([b - a for r in ranges for a, b in r], np.int64)
        logit = np.zeros(len(start), np.float32)
        order = np.argsort(size, kind="stable")
        for a in range(0, len(order), 2048):
            part = order[a:a + 2048]
            t = int(size[part].max())
            step = np.arange(t)[:, None]
            mask = step < size[part]
            at = flat[np.where(mask, start[part] + step, len(flat) - 1)]
            logit[part] = self.network.run(lambda way, i: table[way][at[i]], mask.astype(np.float32))
        return np.split(logit, np.cumsum([len(r) for r in ranges])[:-1])

    def __call__(self, texts: list[str]) -> list[float]:
        if not self.network.trained:
            return [0.0] * len(texts)
        places = self.words.of([words_of(t) for t in texts])
        empty = float(self.network.w["o0"][0])
        return [float(chance(w.max() if len(w) else empty)) for w in self.window_logits(places, self.words.table)]


def _least_hashes(words: list[str], seeds: int = 16) -> tuple[int, ...]:
    """The least word hash under each of several seeds: equal for copies, and for texts that share all but a word or two."""
    if not words:
        return ()
    h = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in set(words)], np.uint64)
    mixed = (h ^ np.arange(1, seeds + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return tuple((mixed ^ mixed >> np.uint64(31)).min(1).tolist())


def train(texts: list[str], labels: list[int], rounds: int = 3, steps: int = 80, batch: int = 128, rate: float = 0.01, folds: int = 4, seed: int = 1) -> Network:
    """A network for labelled texts, in ``rounds`` times ``steps`` steps.

    Half of a batch are windows of toxic texts.  Without rows of both labels
    it stays untrained and scores 0.
    """
    net = Network(seed)
    label = np.array(labels, np.int64)
    if not label.any() or label.all():
        return net
    rng = np.random.default_rng(seed)
    # Texts are kept as numbers of their words alone: all words of all texts are more than a driver should hold.
    number: dict[str, int] = {}
    cut, last = [], {}
    for k, (text, y) in enumerate(zip(texts, labels)):
        ws = words_of(text)
        # Copies would make their rare words look telling: of texts whose least word hashes agree under all seeds one is kept.
        last[y, _least_hashes(ws)] = k
        cut.append(np.array([number.setdefault(w, len(number)) for w in ws], np.int32))
    keep = sorted(last.values())
    cut, label = [cut[k] for k in keep], label[keep]
    every = list(number)
    vocabulary = sorted(every[k] for k in np.unique(np.concatenate(cut)).tolist())
    place = np.zeros(len(every), np.int64)
    place[[number[w] for w in vocabulary]] = np.arange(len(vocabulary))
    places = [place[ws] for ws in cut]
    del number, every, cut
    head, chars = buckets(vocabulary)
    fold = rng.permutation(len(places)) % folds
    hints = [_odds(net, places, label, (fold != f) | (folds == 1), head, chars) for f in range(folds)]
    _odds(net, places, label, fold >= 0, head, chars)
    ranges = [windows(len(p)) for p in places]
    toxic = [k for k, r in enumerate(ranges) if r and label[k]]
    clean = [k for k, r in enumerate(ranges) if r and not label[k]]
    if not toxic or not clean:
        return net
    scores = [np.array([hints[f][p[a:b]].sum(1).max() for a, b in rs]) for p, rs, f in zip(places, ranges, fold)]
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items() if k not in ("word", "char")}
    turn, scorer = 0, Scorer(net)
    for r in range(rounds):
        if r:
            for f in range(folds):
                x = net.inputs(head, chars)
                x[:, ::EACH] = hints[f]
                mine = np.flatnonzero(fold == f)
                for k, w in zip(mine, scorer.window_logits([places[k] for k in mine], net.project(x))):
                    scores[k] = w
        top = [int(np.argmax(s)) if len(s) else 0 for s in scores]
        for _ in range(steps):
            some = [(k, *ranges[k][top[k]]) for k in rng.choice(toxic, batch // 2)]
            some += [(k, *ranges[k][top[k] if rng.random() < 0.75 else int(rng.integers(len(ranges[k])))]) for k in rng.choice(clean, batch // 2)]
            t = max(e - s for _, s, e in some)
            ids = np.full((t, len(some)), -1)
            for k, (d, s, e) in enumerate(some):
                ids[:e - s, k] = places[d][s:e]
            mask = (ids >= 0).astype(np.float32)
            used, where = np.unique(np.maximum(ids, 0), return_inverse=True)
            where = where.reshape(ids.shape)
            x = net.inputs(head[used], chars[used])[where]
            for k, (d, _, _) in enumerate(some):
                x[:, k, ::EACH] = hints[fold[d]][ids[:, k]]
            g, _, _ = net.gradient(x, mask, label[[d for d, _, _ in some]].astype(np.float32))
            turn += 1
            for k, v in g.items():
                m, q = moment[k]
                m += 0.1 * (v - m)
                q += 0.01 * (v * v - q)
                net.w[k] -= (rate * (m / (1 - 0.9**turn)) / (np.sqrt(q / (1 - 0.99**turn)) + 1e-6)).astype(np.float32)
    net.trained = True
    return net


def _odds(net: Network, places: list[np.ndarray], label: np.ndarray, use: np.ndarray, head: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Sets the tables' first inputs to the log odds of a bucket's presence in
    the used texts, drawn in where it is rare; gives both for every word."""
    seen = {"word": np.zeros((2, WORD_BUCKETS)), "char": np.zeros((2, CHAR_BUCKETS))}
    for k in np.flatnonzero(use):
        seen["word"][label[k], np.unique(head[places[k]])] += 1
        own = np.unique(chars[places[k]])
        seen["char"][label[k], own[own >= 0]] += 1
    n = np.bincount(label[use], minlength=2)
    for name, s in seen.items():
        odds = np.log((s[1] + 0.5) / (n[1] + 1)) - np.log((s[0] + 0.5) / (n[0] + 1))
        net.w[name][:, 0] = np.clip(odds, -3, 3) * s.sum(0) / (s.sum(0) + 4)
    return net.inputs(head, chars)[:, ::EACH].copy()


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from: crc32(doc_id as text) mod 3 is 1 (a null id is not held out)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(docs: DataFrame, labels: DataFrame, each: int = 2000, most_chars: int = 50_000) -> Network:
    """A network from at most ``each`` rows of either label, in an order by hash.
    Of a longer text a stretch of ``most_chars`` characters is learned, at a place
    by hash (that bounds the driver's memory; scoring takes whole texts).  An id labelled twice is toxic if any says so;
    of an id with several texts the least is learned."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("order", F.xxhash64("doc_id", F.lit(11))))
    begin = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.greatest(F.length("text") - most_chars, F.lit(0)) + 1).cast("int")
    texts = docs.where("text IS NOT NULL").select("doc_id", F.substring("text", begin + 1, F.lit(most_chars)).alias("text"))
    rows = []
    for y in (0, 1):
        chosen = known.where(f"toxic = {y}").orderBy("order", "doc_id").limit(each).select("doc_id")
        rows += [(r["doc_id"], r["text"], y) for r in texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()]
    rows.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[1]))
    network = train([t for _, t, _ in rows], [y for _, _, y in rows])
    del rows
    hand_back()
    return network


def score_column(network: Network, text: Column) -> Column:
    of = text_udf(lambda: (lambda scorer: lambda texts: {"score": scorer(texts)})(Scorer(network)), "score double", most=250_000)
    return of(text).getField("score")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Learned from ``labels`` (doc_id, toxic) of rows not held out.  A null,
    empty or wordless text gets the score of the network's bias.  Without
    labelled rows of both kinds every score is 0.  Repeated rows and null ids
    are returned as they come, an empty table gives no rows, other columns are
    not looked at.  A very long text is scored whole, 2,048 windows at a time.
    """
    network = learn(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(network, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    score = fresh(docs, "score")
    return docs.withColumn(score, score_column(learn(docs, labels), F.col("text"))).where(F.col(score) < THRESHOLD).drop(score)
