"""A linear-chain conditional random field over token shapes, in numpy.

Tokens are runs of letters, digits and ``+ / _ . - @ %``; a line is a sequence.
A token has a code that packs its shape, what stands in the gap before it, and
the cue class of its word.  A state's score is the sum of weights of the
token's features, of its neighbours' and of the file's; transitions are
learned too, and every line begins and ends in the outside state.

Weights come from a small labelled table by gradient ascent on the
conditional likelihood.  Decoding is exact Viterbi.  A token whose outside
score leads every other state's by more than the two transitions around it can
cost is outside in any best path, so only the runs between such tokens are put
through Viterbi, batched by length.
"""

from __future__ import annotations

import numpy as np

# Character classes: 0 space, 1 newline, 2 lower, 3 upper, 4 digit, 5 joiner, 6 assignment, 7 quote, 8 other, 9 not ASCII.
CLASS = np.full(129, 8, np.uint8)
for _chars, _class in ((" \t\r\x0b\x0c", 0), ("\n", 1), ("abcdefghijklmnopqrstuvwxyz", 2), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 3),
                       ("0123456789", 4), ("+/_.-@%", 5), ("=:", 6), ("\"'`", 7)):
    CLASS[[ord(c) for c in _chars]] = _class
CLASS[128] = 9
IN_TOKEN = np.isin(np.arange(10), (2, 3, 4, 5, 9))
HEX = np.zeros(129, bool)
HEX[[ord(c) for c in "0123456789abcdef"]] = True

# Features of a token: name and number of values, packed into its code in this order.
FEATURES = (("length", 7), ("digits", 4), ("capitals", 4), ("lower", 2), ("joiner", 3), ("changes", 2), ("assigned", 2), ("quoted", 2), ("hex", 2), ("cue", 6))
CODES = int(np.prod([n for _, n in FEATURES]))

# Cue words by class.
CUES = {
    1: "password passwd passphrase pwd secret token apikey api_key api-key access_key secret_key private_key auth authorization bearer credential credentials",
    2: "commit sha sha1 sha256 md5 checksum digest hash uuid build version revision etag blob isbn",
    3: "mr mr. mrs mrs. ms dr dr. prof prof. name named contact dear signed regards author by sincerely herr frau señor señora monsieur madame",
    4: "ssn passport iban account phone tel tel. call fax mobile license licence id dob bsn nino no. nr nr. number",
    5: """anna ben carla david elena frank greta hugo ines jakob karin louis maria nils olga paul rosa stefan tom vera
        james mary john patricia robert jennifer michael linda william elizabeth richard susan joseph jessica thomas sarah charles karen
        peter hans klaus wolfgang ursula monika sabine jürgen andreas pierre jean marie claire sophie antoine juan carlos josé luis ana
        carmen pilar lucía giovanni marco giulia jan kees pieter willem johanna sanne emma liam noah olivia ahmed fatima mohammed ali
        wei yuki hiroshi ivan natasha sergei piotr katarzyna lars ingrid sven""",
}
PART = 1_000_000
_BASE = 1_000_003
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _word_hash(words: list[str]) -> np.ndarray:
    return np.array([sum(ord(c) * pow(_BASE, k, 1 << 64) for k, c in enumerate(w)) % (1 << 64) for w in words], np.uint64)


def file_feature(assigned, many):
    return np.where(assigned == 0, 0, np.where(assigned * 10 < many, 1, 2))


def line_parts(text: str, most: int) -> list[tuple[int, str]]:
    """A text as parts of whole lines of about ``most`` characters (one line at least), with their places."""
    out, at = [], 0
    while at < len(text):
        end = text.find("\n", at + most)
        end = len(text) if end < 0 else end + 1
        out.append((at, text[at:end]))
        at = end
    return out


class Tokens:
    """The tokens of some texts: start and end in the joined text, document, code, line, and file feature."""

    def __init__(self, texts: list[str], file: list[int] | None = None):
        joined = "\n".join(texts) + "\n"
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.offset = np.cumsum(np.array([0, *(len(t) + 1 for t in texts)], np.int64))
        small = np.minimum(code, 128)
        kind = CLASS[small]
        inside = IN_TOKEN[kind]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[::2], edge[1::2]
        n = len(self.start)
        self.doc = np.searchsorted(self.offset, self.start, "right") - 1
        if not n:
            self.code, self.line, self.file = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.assigned = self.many = np.zeros(len(texts), np.int64)
            return
        size = self.end - self.start

        def count(c: int) -> np.ndarray:
            """Running count of a class."""
            return np.concatenate((np.zeros(1, np.int64), np.cumsum(kind == c, dtype=np.int64)))

        def within(c: int) -> np.ndarray:
            running = count(c)
            return running[self.end] - running[self.start]

        def before(c: int) -> np.ndarray:
            """Count in the gap before a token."""
            running = count(c)
            return running[self.start] - np.concatenate((running[:1], running[self.end[:-1]]))

        digit, upper, lower, joiner = (within(c) for c in (4, 3, 2, 5))
        self.line = np.cumsum(before(1) > 0)
        change = np.concatenate((np.zeros(2, np.int32), np.cumsum(kind[1:] != kind[:-1], dtype=np.int32)))
        changes = change[self.end] - change[self.start + 1]
        not_hex = np.concatenate((np.zeros(1, np.int32), np.cumsum(~HEX[small], dtype=np.int32)))
        first = kind[self.start]
        letters = size - digit - joiner
        values = (
            np.searchsorted([4, 8, 12, 16, 24, 40], size, "right"),
            np.where(digit == 0, 0, np.where(digit == size, 3, np.where(digit * 10 < size * 3, 1, 2))),
            np.where(upper == 0, 0, np.where((upper == letters) & (letters > 1), 3, np.where((upper == 1) & (first == 3), 1, 2))),
            (lower > 0).astype(np.int64),
            np.where(joiner == 0, 0, np.where((joiner == 1) & (kind[self.end - 1] == 5), 2, 1)),
            (changes * 10 >= size * 3).astype(np.int64) & (size >= 8),
            (before(6) > 0).astype(np.int64),
            (before(7) > 0).astype(np.int64),
            ((not_hex[self.end] == not_hex[self.start]) & (digit > 0)).astype(np.int64),
            self._cues(code, kind),
        )
        packed = np.zeros(n, np.int64)
        for (_, many), value in zip(FEATURES, values):
            packed = packed * many + value
        self.code = packed
        # File feature: how much of the file is assignments (0 none, 1 some, 2 one or more in every ten tokens).
        self.assigned = np.bincount(self.doc, weights=values[6], minlength=len(texts)).astype(np.int64)
        self.many = np.bincount(self.doc, minlength=len(texts))
        self.file = (file_feature(self.assigned, self.many) if file is None else np.array(file, np.int64))[self.doc]

    def _cues(self, code: np.ndarray, kind: np.ndarray) -> np.ndarray:
        low = np.where(kind == 3, code + 32, code).astype(np.uint64)
        power = _powers(_BASE, len(low) + 1)
        run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(low * power[:-1])))
        back = _powers(_INVERSE, len(low) + 1)
        word = (run[self.end] - run[self.start]) * back[self.start]
        names = [(w, c) for c, words in CUES.items() for w in words.split()]
        known = _word_hash([w for w, _ in names])
        order = np.argsort(known)
        known, cue = known[order], np.array([c for _, c in names])[order]
        at = np.minimum(np.searchsorted(known, word), len(known) - 1)
        return np.where(known[at] == word, cue[at], 0)


def _features() -> np.ndarray:
    """(CODES, features): which feature values each code has, as columns of a one-hot table."""
    rest, out, base = np.arange(CODES), [], sum(n for _, n in FEATURES)
    for _, n in reversed(FEATURES):
        base -= n
        out.append(base + rest % n)
        rest = rest // n
    return np.stack(out[::-1], axis=1)


class Crf:
    """Scores by code, neighbour's code and file feature, and transitions; state 0 is outside."""

    def __init__(self, states: list[str]):
        self.states = states
        s, f = len(states), sum(n for _, n in FEATURES)
        self.weights = {"own": np.zeros((f, s)), "before": np.zeros((f, s)), "after": np.zeros((f, s)), "file": np.zeros((3, s)), "step": np.zeros((s, s))}

    def prepare(self) -> Crf:
        """Tables by code, for decoding."""
        features = _features()
        self.table = {k: self.weights[k][features].sum(1).astype(np.float32) for k in ("own", "before", "after")}
        return self

    def scores(self, tokens: Tokens) -> np.ndarray:
        code, line = tokens.code, tokens.line
        out = self.table["own"][code] + self.weights["file"].astype(np.float32)[tokens.file]
        same = line[1:] == line[:-1]
        out[1:] += self.table["before"][code[:-1]] * same[:, None]
        out[:-1] += self.table["after"][code[1:]] * same[:, None]
        return out

    def decode(self, tokens: Tokens) -> np.ndarray:
        """The best state of each token."""
        best = np.zeros(len(tokens.code), np.int64)
        if not len(best):
            return best
        score = self.scores(tokens)
        step = self.weights["step"].astype(np.float32)
        # What the transitions into and out of a state can be better than those of outside.
        edge = (step - step[:, :1]).max(0) + (step - step[:1]).max(1)
        lead = score[:, 0] - (score[:, 1:] + edge[1:]).max(1)
        open_ = np.flatnonzero(lead <= 1e-3)
        if not len(open_):
            return best
        new = np.concatenate(([True], (open_[1:] != open_[:-1] + 1) | (tokens.line[open_[1:]] != tokens.line[open_[:-1]])))
        heads = np.flatnonzero(new)
        size = np.diff(np.append(heads, len(open_)))
        heads = open_[heads]
        order = np.argsort(size, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(np.ceil(np.log2(size[order])))) + 1):
            for a in range(0, len(part), 4096):
                self._viterbi(score, step, heads[part[a:a + 4096]], size[part[a:a + 4096]], best)
        return best

    @staticmethod
    def _viterbi(score: np.ndarray, step: np.ndarray, head: np.ndarray, size: np.ndarray, best: np.ndarray) -> None:
        long = int(size.max())
        now = score[head] + step[0]
        came = np.zeros((long, *now.shape), np.int8)
        ended = np.zeros(len(head), np.int64)
        for t in range(long):
            if t:
                on = np.flatnonzero(size > t)
                path = now[on][:, :, None] + step[None]
                came[t, on] = path.argmax(1)
                now[on] = path.max(1) + score[head[on] + t]
            last = size == t + 1
            ended[last] = (now[last] + step[:, 0]).argmax(1)
        state = ended.copy()
        for t in range(long - 1, -1, -1):
            on = np.flatnonzero(size > t)
            best[head[on] + t] = state[on]
            state[on] = came[t, on, state[on]]

    def fit(self, texts: list[str], labels: list[list[tuple[int, int, str]]], rounds: int = 150, rate: float = 0.1, decay: float = 1e-3) -> Crf:
        """Learns from texts and their labelled spans (start, end, kind); a kind k has the states B-k and I-k."""
        tokens = Tokens(texts)
        target = np.zeros(len(tokens.code), np.int64)
        for d, spans in enumerate(labels):
            for a, b, kind in spans:
                at = np.flatnonzero((tokens.doc == d) & (tokens.end > tokens.offset[d] + a) & (tokens.start < tokens.offset[d] + b))
                target[at] = self.states.index(f"I-{kind}")
                target[at[:1]] = self.states.index(f"B-{kind}")
        features = _features()[tokens.code]
        same = np.concatenate((tokens.line[1:] == tokens.line[:-1], [False]))
        before, after = np.flatnonzero(same) + 1, np.flatnonzero(same)
        heads = np.flatnonzero(np.concatenate(([True], ~same[:-1])))
        size = np.diff(np.append(heads, len(target)))
        w, s = self.weights, len(self.states)
        moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in w.items()}
        for turn in range(1, rounds + 1):
            score = w["own"][features].sum(1) + w["file"][tokens.file]
            score[before] += w["before"][features[before - 1]].sum(1)
            score[after] += w["after"][features[after + 1]].sum(1)
            chance, pair = self._marginals(score, w["step"], heads, size)
            miss = np.eye(s)[target] - chance
            grad = {k: np.zeros_like(v) for k, v in w.items()}
            for column in range(features.shape[1]):
                np.add.at(grad["own"], features[:, column], miss)
                np.add.at(grad["before"], features[before - 1, column], miss[before])
                np.add.at(grad["after"], features[after + 1, column], miss[after])
            np.add.at(grad["file"], tokens.file, miss)
            np.add.at(grad["step"], (np.where(np.isin(np.arange(len(target)), heads), 0, np.roll(target, 1)), target), 1)
            np.add.at(grad["step"], (target[heads + size - 1], np.zeros(len(heads), np.int64)), 1)
            grad["step"] -= pair
            for k in w:
                g = grad[k] / len(heads) - decay * w[k]
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w[k] += rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
        return self.prepare()

    @staticmethod
    def _marginals(score: np.ndarray, step: np.ndarray, heads: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State chances of each token, and expected transitions."""
        long, s = int(size.max()), len(step)

        def total(x, axis):
            top = x.max(axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))

        ahead, back = np.zeros_like(score), np.zeros_like(score)
        for t in range(long):
            on = heads[size > t] + t
            ahead[on] = score[on] + (step[0] if t == 0 else total(ahead[on - 1][:, :, None] + step[None], 1))
        for t in range(long - 1, -1, -1):
            last, on = heads[size == t + 1] + t, heads[size > t + 1] + t
            back[last] = step[:, 0]
            back[on] = total(step[None] + (score[on + 1] + back[on + 1])[:, None, :], 2)
        whole = np.repeat(total(ahead[heads + size - 1] + step[:, 0], 1), size)
        chance = np.exp(ahead + back - whole[:, None])
        pair = np.zeros((s, s))
        pair[0] += chance[heads].sum(0)
        pair[:, 0] += chance[heads + size - 1].sum(0)
        on = np.setdiff1d(np.arange(len(score)), heads)
        pair += np.exp(ahead[on - 1][:, :, None] + step[None] + (score[on] + back[on])[:, None, :] - whole[on][:, None, None]).sum(0)
        return chance, pair

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) of the tagged spans of each text, in code points, joiners at either end left out.

        A text longer than ``PART`` is tagged by parts of whole lines, which
        share only the file feature, so memory is bounded but for one line."""
        if any(len(t) > PART for t in texts):
            out = []
            for text in texts:
                parts = line_parts(text, PART)
                counts = [(int(t.assigned.sum()), int(t.many.sum())) for t in (Tokens([p]) for _, p in parts)] if len(parts) > 1 else []
                file = [int(file_feature(*np.array(counts).sum(0)))] if counts else None
                out.append([(k, a + at, b + at) for at, p in parts for k, a, b in self._spans([p], file)[0]])
            return out
        return self._spans(texts)

    def _spans(self, texts: list[str], file: list[int] | None = None) -> list[list[tuple[str, int, int]]]:
        tokens = Tokens(texts, file)
        state = self.decode(tokens)
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        tagged = np.flatnonzero(state)
        last = -2
        for i in tagged.tolist():
            name, d = self.states[state[i]], int(tokens.doc[i])
            base = int(tokens.offset[d])
            a, b = int(tokens.start[i]) - base, int(tokens.end[i]) - base
            if name[0] == "I" and last == i - 1 and tokens.line[i] == tokens.line[last] and out[d] and out[d][-1][0] == name[2:]:
                out[d][-1] = (name[2:], out[d][-1][1], b)
            else:
                out[d].append((name[2:], a, b))
            last = i
        for d, found in enumerate(out):
            trimmed = []
            for kind, a, b in found:
                while b > a and texts[d][b - 1] in "+/_.-@%":
                    b -= 1
                while a < b and texts[d][a] in "/_.-@%":
                    a += 1
                if a < b:
                    trimmed.append((kind, a, b))
            out[d] = trimmed
        return out
