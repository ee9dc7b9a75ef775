"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The words of a chunk of texts are encoded together.  Their symbols lie in one
flat array; a round finds the best pair rank of each word (a segmented
minimum), merges that pair in every word at once, left to right without
overlap, and closes the gaps; words without a pair left drop out.

Exactness.  The library merges one pair at a time: best score, then leftmost.
Merging all places of a word's best pair in one round gives the same result
unless the merged piece takes part in a pair of an equal or better rank; for
such pieces only the leftmost place is merged in a round.  A text is cut into
words before spaces and around newlines, and long words where two neighbouring
characters occur in no piece, so no merge crosses a cut.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_udf

SPACE = "▁"
NONE = np.iinfo(np.int64).max


class PieceModel:
    """The vocabulary of a SentencePiece BPE model file, with its merge table."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        if lib.normalize(" a  b ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}b{SPACE}" or lib.normalize("ﬁ") != f"{SPACE}ﬁ":
            raise ValueError("only models with the identity normalizer and a dummy prefix are supported")
        n = lib.vocab_size()
        self.text = [lib.id_to_piece(i) for i in range(n)]
        kind = ["byte" if lib.is_byte(i) else "skip" if lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) else "piece" for i in range(n)]
        if any(lib.is_unused(i) for i in range(n)) or kind.count("byte") != 256:
            raise ValueError("only models with byte fallback and no unused pieces are supported")
        self.byte_id = [0] * 256
        self.byte_of: dict[int, int] = {}
        for i in range(n):
            if kind[i] == "byte":
                self.byte_of[i] = int(self.text[i][1:-1], 16)
                self.byte_id[self.byte_of[i]] = i
        self.is_byte = np.array([k == "byte" for k in kind])
        self.name = [str(i) for i in range(n)]
        self.said = ["" if lib.is_control(i) else " ⁇ " if lib.is_unknown(i) else p.replace(SPACE, " ") for i, p in enumerate(self.text)]
        pieces = {self.text[i]: i for i in range(n) if kind[i] == "piece"}
        # Symbols: pieces by their id, then characters that only occur inside pieces, then any other character.
        symbol = dict(pieces)
        for p in pieces:
            for c in p:
                symbol.setdefault(c, n + len(symbol))
        self.symbols = max(symbol.values()) + 2
        self.other = self.symbols - 1
        self.pieces = n
        chars = sorted(c for c in symbol if len(c) == 1)
        self.char_code = np.array([ord(c) for c in chars], np.uint32)
        self.char_symbol = np.array([symbol[c] for c in chars], np.int64)
        score = {i: lib.get_score(i) for i in pieces.values()}
        level = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        pair, made, rank = [], [], []
        for p, i in pieces.items():
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    pair.append(a * self.symbols + b)
                    made.append(i)
                    rank.append(level[score[i]])
        order = np.argsort(pair)
        self.pair = np.array(pair, np.int64)[order]
        self.made = np.array(made, np.int64)[order]
        self.rank = np.array(rank, np.int64)[order]
        # Pieces that open a pair as good as their own: merged one place at a time.
        own = np.full(self.symbols, -1, np.int64)
        own[self.made] = self.rank
        self.alone = np.zeros(self.symbols, bool)
        for part in (self.pair // self.symbols, self.pair % self.symbols):
            self.alone[part[self.rank <= own[part]]] = True
        joints = {p[k:k + 2] for p in pieces for k in range(len(p) - 1)}
        self.joint = np.sort(np.array([ord(a) << 32 | ord(b) for a, b in joints], np.int64))
        self.longest_space = max((len(p) for p in pieces if not p.strip(SPACE)), default=1)
        self.newline_apart = not any("\n" in p for p in pieces)

    # -- encoding ---------------------------------------------------------
    def words(self, text: str) -> list[str]:
        """The text with its dummy prefix, cut where no merge can cross.  Words join to it."""
        if not text:
            return []
        text = " " + text.replace(SPACE, " ")
        return _WORDS.findall(text) if self.newline_apart else _WORDS_ONLY_SPACES.findall(text)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, flat, and the number of ids of each word."""
        flat = "".join(words).replace(" ", SPACE)
        code = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), size)
        cut = self._cuts(code, word, size)
        segment = np.cumsum(cut) - 1
        at = np.minimum(np.searchsorted(self.char_code, code), len(self.char_code) - 1)
        symbol = np.where(self.char_code[at] == code, self.char_symbol[at], self.other)
        symbol, start = self._merge(symbol, segment)
        # Symbols that are no piece become the bytes of their character.
        plain = symbol < self.pieces
        if plain.all():
            return symbol, np.bincount(word[start], minlength=len(words))
        raw = [list(flat[i].encode("utf-8", "surrogatepass")) for i in start[~plain].tolist()]
        n = np.ones(len(symbol), np.int64)
        n[~plain] = [len(r) for r in raw]
        ids = np.repeat(symbol, n)
        ids[np.repeat(~plain, n)] = [self.byte_id[b] for r in raw for b in r]
        return ids, np.bincount(np.repeat(word[start], n), minlength=len(words))

    def _cuts(self, code: np.ndarray, word: np.ndarray, size: np.ndarray) -> np.ndarray:
        cut = np.ones(len(code), bool)
        cut[1:] = word[1:] != word[:-1]
        long = np.flatnonzero((size > 64)[word])
        if len(long):
            pair = code[long - 1].astype(np.int64) << 32 | code[long].astype(np.int64)
            at = np.minimum(np.searchsorted(self.joint, pair), len(self.joint) - 1)
            cut[long] |= self.joint[at] != pair
            # A run of spaces fills up whole longest pieces from its left; its last space stays with the word.
            space = code == ord(SPACE)
            first = space & ~np.concatenate(([False], space[:-1]))
            first |= space & cut
            place = np.arange(len(code)) - np.maximum.accumulate(np.where(first, np.arange(len(code)), 0))
            cut |= space & (place > 0) & (place % self.longest_space == 0)
        return cut

    def _look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a * self.symbols + b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        known = self.pair[at] == key
        return np.where(known, self.rank[at], NONE), np.where(known, self.made[at], -1)

    def _merge(self, symbol: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols in place order, and where each starts."""
        start = np.arange(len(symbol))
        rank, made = np.full(len(symbol), NONE), np.full(len(symbol), -1)
        inner = np.flatnonzero(segment[1:] == segment[:-1])
        rank[inner], made[inner] = self._look(symbol[inner], symbol[inner + 1])
        done_symbol, done_start = [], []
        while len(symbol):
            heads = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            length = np.diff(np.append(heads, len(symbol)))
            least = np.minimum.reduceat(rank, heads)
            over = least == NONE
            if over.any():
                mask = np.repeat(over, length)
                done_symbol.append(symbol[mask])
                done_start.append(start[mask])
                stay = ~mask
                symbol, segment, start, rank, made = symbol[stay], segment[stay], start[stay], rank[stay], made[stay]
                least, length = least[~over], length[~over]
                if not len(symbol):
                    break
                heads = np.cumsum(length) - length
            hit = np.flatnonzero(rank == np.repeat(least, length))
            # Neighbouring hits overlap: every second one of a run, from its left.
            run = np.concatenate(([True], hit[1:] != hit[:-1] + 1))
            place = np.arange(len(hit)) - np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            take = place % 2 == 0
            head = np.searchsorted(heads, hit, "right") - 1
            leftmost = np.concatenate(([True], head[1:] != head[:-1]))
            one = np.zeros(len(heads), bool)
            one[head[self.alone[made[hit]]]] = True
            hit = hit[np.where(one[head], leftmost, take)]
            symbol[hit] = made[hit]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            now = hit - np.arange(len(hit))  # their places once the gaps are closed
            symbol, segment, start, rank, made = symbol[keep], segment[keep], start[keep], rank[keep], made[keep]
            for left in (now[now > 0] - 1, now):
                left = left[left + 1 < len(symbol)]
                same = segment[left] == segment[left + 1]
                rank[left], made[left] = NONE, -1
                left = left[same]
                rank[left], made[left] = self._look(symbol[left], symbol[left + 1])
            if now[-1] == len(symbol) - 1:
                rank[-1], made[-1] = NONE, -1
        if not done_symbol:
            return symbol, start
        symbol, start = np.concatenate(done_symbol), np.concatenate(done_start)
        order = np.argsort(start, kind="stable")
        return symbol[order], start[order]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, as the library's ``encode``."""
        words = [self.words(t) for t in texts]
        ids, n = self.encode_words([w for ws in words for w in ws])
        ends = np.concatenate(([0], np.cumsum(n)))
        out, k = [], 0
        for ws in words:
            out.append(ids[ends[k]:ends[k + len(ws)]].tolist())
            k += len(ws)
        return out

    # -- decoding ---------------------------------------------------------
    def spell(self, ids: list[int]) -> str:
        """Text of a run of ids, the dummy prefix included."""
        out, raw = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(_utf8(bytes(raw)))
                raw = bytearray()
            out.append(self.said[i])
        if raw:
            out.append(_utf8(bytes(raw)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """As the library's ``decode``: the first space of a leading space piece is the dummy prefix."""
        text = self.spell(ids)
        return text[1:] if text.startswith(" ") else text


_WORDS = re.compile(r" *[^ \n]+| +|\n")
_WORDS_ONLY_SPACES = re.compile(r" *[^ ]+| +")


def _utf8(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[i:i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                i += 1
        return "".join(out)


class Codec:
    """Encodes and decodes texts word by word; words seen before come from a bounded cache."""

    def __init__(self, path: str, most_words: int = 300_000):
        self.model = PieceModel(path)
        self.most = most_words
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids: list[str] = []
        self.n: list[int] = []
        self.spelt: list[str] = []

    def _learn(self, words: list[str]) -> None:
        model = self.model
        ids, n = model.encode_words(words)
        ends = np.cumsum(n)
        cuts = list(zip((ends - n).tolist(), ends.tolist()))
        plain = [True] * len(words)
        for k in np.unique(np.searchsorted(ends, np.flatnonzero(model.is_byte[ids]), "right")).tolist():
            plain[k] = False
        ids = ids.tolist()
        name, said = [model.name[i] for i in ids], [model.said[i] for i in ids]
        at = len(self.ids)
        self.place.update(zip(words, range(at, at + len(words))))
        self.ids += [",".join(name[a:b]) for a, b in cuts]
        self.n += n.tolist()
        self.spelt += ["".join(said[a:b]) if p else model.spell(ids[a:b]) for p, (a, b) in zip(plain, cuts)]

    def __call__(self, texts: list[str]) -> dict[str, list]:
        if len(self.ids) > self.most:
            self._clear()
        cut = [self.model.words(t) for t in texts]
        new = set().union(*cut).difference(self.place)
        if new:
            self._learn(list(new))
        out: dict[str, list] = {"n_tokens": [], "ids": [], "decoded": []}
        for words in cut:
            at = [self.place[w] for w in words]
            out["n_tokens"].append(sum([self.n[i] for i in at]))
            out["ids"].append(",".join([self.ids[i] for i in at]))
            spelt = "".join([self.spelt[i] for i in at])
            out["decoded"].append(spelt[1:] if spelt.startswith(" ") else spelt)
        return out


def encode_texts(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``pieces``: n_tokens, ids (decimal, comma-joined) and the decoded text."""
    of = text_udf(lambda: Codec(model_path), "n_tokens long, ids string, decoded string")
    return docs.withColumn("pieces", of(F.col(text)))


def encode_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs``.

    A null or empty text has no ids, and the digests of the empty string.
    Repeated rows and null ids are returned as they come, an empty table gives
    no rows, other columns are not looked at.  A very long text is one piece of
    a task's work; its symbol arrays take some 40 bytes a character.
    """

    def make():
        codec = Codec(model_path)

        def of(texts):
            got = codec(texts)
            sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
            return {"n_tokens": got["n_tokens"], "ids_sha256": list(map(sha, got["ids"])), "decoded_sha256": list(map(sha, got["decoded"]))}

        return of

    of = text_udf(make, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return docs.select("doc_id", of(F.col("text")).alias("r")).select("doc_id", "r.*")
