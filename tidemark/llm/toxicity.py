"""Toxicity scores of texts, restored by a noisy-channel decoder first.

A character model (four-character windows over all documents, shorter windows where the longer
are rare) and a channel make a lattice of readings. The channel has two kinds of word, plain and
disguised. In a plain word every character that is no letter is a break between words, at the
rate the corpus has it. A word is disguised at a small rate; in it a look-alike or a letter of
another alphabet may stand for a letter, a stretched letter is read once or
twice, and a blank, mark or character without width between letters is left out. Viterbi search
takes the likeliest reading. The channel's rates are learned from the corpus: first with even
odds, then all documents are decoded once and what the likeliest readings used is counted. A
disguised word keeps a rate of `LEAST` at least, so that a corpus without disguises does not
rule them out in new texts. A blank or mark between single letters costs little in a disguised
word, one that cuts a word into longer pieces as much as a disguise each time. Texts are scored with
readings that are disguised at odds of e**-`ODDS` already, as readings add words only.

The lattice reads odd tokens, stretched words, runs of short words of which one is rare and two are
likelier as one (or one has a look-alike in it), and runs of
three words or more of any length that the character model prefers as one at the price of a
disguise. Of two neighbours it has two paths only, which are compared for every blank of the text
at once; as what the readings add never replaces the words, a pair is also read as one where
that is likelier by `SPLIT` before the price of a disguise. A joined pair counts as a whole word, not
by its beginning. Odd tokens and runs longer than `SPAN` characters are decoded in pieces that
overlap by half, so that a word of up to half of it is whole in one of them.

The classifier is fitted on at most `max_rows` labelled rows, drawn by a hash of doc_id, and
keeps at most `max_features` features; the character counts cover every document.

Null and empty texts get the score of a text without evidence; labels that are null, or of
ids that have no document, are not used; several labels of an id count as toxic if one is; of
several documents with one id the one with the least hash is learned from;
without usable labels of both classes every score is the share of toxic ones (0 if none);
no documents give no rows; repeated rows are scored each for itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from math import log
from unicodedata import combining, normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, utf8

# What a character may stand for besides itself.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c",
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɡ": "g",
}
WIDTHLESS = "\u00ad\u200b\u200c\u200d\u2060\ufeff"

SIZE = 28  # boundary, a-z, any other letter
_CODE = np.full(256, 0, np.uint8)
for _c in range(26):
    _CODE[ord("a") + _c] = _CODE[ord("A") + _c] = _c + 1
_CODE[128:] = 27
_POINTS = np.full(0x110000, 27, np.uint8)  # by code point
_POINTS[:128] = _CODE[:128]

FOREIGN = "".join(c for c in LOOKALIKES if ord(c) > 127 and c.isalpha())
ODD = re.compile(r"[0-9@$!|+€(._*~'\-]")
STRANGE = re.compile(f"[{FOREIGN}{WIDTHLESS}\uff21-\uff3a\uff41-\uff5a\u0300-\u036f]")
LATIN = re.compile(f"[a-z0-9\u00df-\u024f{FOREIGN}{WIDTHLESS}\uff41-\uff5a\u0300-\u036f]*")
DIGIT = re.compile(r"[0-9@$!|+€(]")
SYMBOL = re.compile(r"[@$!|+€(]")
STRETCH = re.compile(r"(.)\1\1")
UNLIKELY = re.compile("[12]*2[12]*")  # over one mark a word: 0 long, 1 short, 2 short and rare
SHORT, RARE, SPAN, BLOCK = 3, 2e-4, 64, 100_000
LEAST = 1e-5  # the least rate of disguised words
ODDS = 6.0  # readings of a span are taken as disguised at odds of e**-6 already
SPLIT = 2.0  # neighbours that are likelier as one word by this log ratio are read as one too
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "@$") + "«»¿¡“”„…–—"
TAIL = "@$"
PARTS = re.compile(r"[\W_]+")


def window_counts(texts: Iterable[bytes]) -> np.ndarray:
    """Counts of all windows of four characters over the alphabet above."""
    counts = np.zeros(SIZE**4, np.int64)
    for text in texts:
        c = _CODE[np.frombuffer(b"   " + text + b" ", np.uint8)].astype(np.int32)
        counts += np.bincount(((c[:-3] * SIZE + c[1:-2]) * SIZE + c[2:-1]) * SIZE + c[3:], minlength=SIZE**4)
    return counts


def character_counts(docs: DataFrame) -> DataFrame:
    """win, n over every text: the windows, and from 28**4 on the single bytes; at most 28**4 +
    256 rows, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, single = np.zeros(SIZE**4, np.int64), np.zeros(256, np.int64)

        def add(group: list[bytes]) -> None:
            nonlocal total, single
            joined = b"   ".join(group)
            total += window_counts([joined])
            single += np.bincount(np.frombuffer(joined, np.uint8), minlength=256)

        for batch in batches:
            texts, group, size = batch.column(0).to_pylist(), [], 0
            for t in texts:  # a megabyte or so at a time
                group.append(t)
                size += len(t)
                if size > 1 << 20:
                    add(group)
                    group, size = [], 0
            add(group)
        both = np.concatenate([total, single])
        at = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(both[at])], names=["win", "n"])

    return docs.select(utf8().alias("text")).mapInArrow(run, "win int, n bigint").groupBy("win").agg(F.sum("n").alias("n"))


def _base(c: str) -> str:
    """The letter a-z of a letter of full width, or nothing."""
    return normalize("NFKC", c) if "\uff21" <= c <= "\uff5a" else ""


def _code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if ord(c) > 127 else 0


class Decoder:
    """Viterbi search over the readings of odd tokens and runs of words.

    used: how often each reading was taken (names as in _options); None before that is known, and
    only then readings tell what they used.
    odds: log odds that a word is disguised are raised by this."""

    def __init__(self, win: np.ndarray, n: np.ndarray, used: dict[str, int] | None = None, odds: float = 0.0):
        both = np.zeros(SIZE**4 + 256)
        both[win] = n
        windows, self.single = both[: SIZE**4], both[SIZE**4 :]
        cube = windows.reshape((SIZE,) * 4)
        chance = np.full(SIZE, 1 / SIZE)
        for k in range(4):  # windows of k + 1 characters, by Witten and Bell's weights
            counts = cube.sum(tuple(range(3 - k))) if k < 3 else cube
            total, kinds = counts.sum(-1, keepdims=True), (counts > 0).sum(-1, keepdims=True)
            chance = (counts + kinds * chance) / np.maximum(total + kinds, 1) + (total == 0) * chance
        self.table = np.log(chance + 1e-12).astype(np.float32).reshape(-1)
        self.logp = self.table.tolist()
        self.letters = cube.sum((0, 1, 2))
        self.words = max(1.0, cube[:, :, 1:, 0].sum())
        self.ones, self.twos = cube[:, 0, :, 0].sum(0), cube[0, :, :, 0]
        triple = cube[0, 1:, 1:, 1:] * np.divide(cube[1:, 1:, 1:, 0], np.maximum(cube[1:, 1:, 1:].sum(3), 1))
        self.threes = triple
        used = used or {}
        self.used = used
        self.reads: Counter = Counter()  # by the letter that is written otherwise; "" for what is left out
        for name, k in used.items():
            if len(name) == 2 and name[1] != "=":
                self.reads["" if name[1] == "-" else name[1]] += k
        self.price = log(max(LEAST, (used.get("disguised", 0) + 1) / self.words if used else 1e-4))
        self.enter = min(0.0, self.price + odds)
        self.known: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {}
        self.options: dict[str, list[tuple[str, float, str]]] = {}
        self.marks = Known(self.mark)

    def _rate(self, name: str, reads: str) -> float:
        """Log rate of one way to write a letter in disguised words, or to put something between."""
        return log((self.used.get(name, 0) + 1.0) / (self.reads[reads] + 2.0))

    def _plain(self, c: str) -> float:
        """Log rate of a character among the breaks (or the letters that are not a-z)."""
        seen = self.single[ord(c)] if ord(c) < 128 else 1.0
        if c == " ":
            seen += self.single[9:14].sum()
        return log((seen if not self.used or ord(c) < 128 else self.used.get(c + "=", 0) + 1.0) / max(self.letters[27 if c.isalpha() else 0], 1.0) + 1e-9)

    def _options(self, c: str) -> list[tuple[str, float, str]]:
        """Readings of a character: text, log rate, name to count it by. A name that ends in =
        keeps the word plain."""
        got = self.options.get(c)
        if got is None:
            reads = LOOKALIKES.get(c, "") or (_base(c) if c.isalpha() else "")
            if "a" <= c <= "z":
                got = [(c, 0.0, "")]
            elif c.isalpha():
                got = [(c, self._plain(c) if reads else 0.0, c + "=" if reads else "")]
            elif c in WIDTHLESS or combining(c):
                got = [("", self._rate(c + "-", ""), c + "-")]
            else:
                got = [(" ", self._plain(c), c + "=")]
                if not reads and not c.isdigit():
                    got.append(("", self._rate(c + "-", ""), c + "-"))
            got += [(x, self._rate(c + x, x), c + x) for x in reads]
            self.options[c] = got
        return got

    def restore(self, token: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """The likeliest readings of a token or run (lower case), one a piece, and the names of
        what they used."""
        got = self.known.get(token)
        if got is None:
            if len(self.known) > 50_000:
                self.known.clear()
            pieces = [self._search(token[a : a + SPAN]) for a in range(0, max(len(token) - SPAN // 2, 1), SPAN // 2)]
            got = self.known[token] = tuple(p.strip() for p, _ in pieces), tuple(x for _, names in pieces for x in names)
        return got

    def _alone(self, token: str, at: int) -> bool:
        """Is this character the only one between two blanks or marks?"""
        return all(k < 0 or k >= len(token) or self._options(token[k])[-1][0] == "" for k in (at - 1, at + 1))

    def _search(self, token: str) -> tuple[str, tuple[str, ...]]:
        slots: list[list[tuple[str, float, str]]] = []
        at = 0
        while at < len(token):
            c, run = token[at], 1
            while at + run < len(token) and token[at + run] == c:
                run += 1
            options = self._options(c)
            if run > 2 and (c.isalpha() or c in LOOKALIKES):
                once = self._rate("stretch", "")
                slots.append(
                    [(x * k, p + once, "stretch") for x, p, _ in options if x and x != " " for k in (1, 2)] + [((c if c.isalpha() else " ") * run, 0.0 if c.isalpha() else options[0][1] * run, "")]
                )
            elif run == 1 and options[-1][0] == "" and not (self._alone(token, at - 1) and self._alone(token, at + 1)):
                slots.append([*options[:-1], ("", self.price, "cut")])
            else:
                slots += [options] * run
            at += run
        logp, enter, cubed, counting = self.logp, self.enter, SIZE**3, not self.used
        # by the last three characters' codes, and that plus cubed within a disguised word
        states: dict[int, tuple[float, str, tuple[str, ...]]] = {0: (0.0, "", ())}
        for slot in [*slots, [(" ", 0.0, "")]]:
            after: dict[int, tuple[float, str, tuple[str, ...]]] = {}
            told = [(chars, q, name, bool(name) and name[-1] != "=", [_code(c) for c in chars]) for chars, q, name in slot]
            for state, (p, text, names) in states.items():
                for chars, q, name, odd, codes in told:
                    r, s, disguised = p + q, state, state >= cubed
                    if disguised:
                        s -= cubed
                    entered = odd and not disguised
                    if entered:
                        disguised = True
                        if name != "cut":
                            r += enter
                    for code in codes:
                        s = s * SIZE + code
                        r += logp[s]
                        s %= cubed
                        if not code:
                            disguised = False
                    if disguised:
                        s += cubed
                    held = after.get(s)
                    if held is None or r > held[0]:
                        after[s] = r, text + chars, names + ((name, "disguised") if entered else (name,)) if counting and name else names
            states = after
        return max(states.values())[1:]

    def gains(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How much likelier the character model finds a text (its codes, three breaks before and
        four after) without the break at each of the places."""
        a, b, c, _, d, e, f = (data[at + k].astype(np.int32) for k in range(-3, 4))  # the break is 0
        table, n2, n3 = self.table, SIZE**2, SIZE**3
        bc, de = b * SIZE + c, d * SIZE + e
        ends, bc, c, d_f = (a * n2 + bc) * SIZE, bc * n2, c * n3, de * SIZE + f
        split = table[ends] + table[bc + d] + table[c + de] + table[d_f]
        return table[ends + d] + table[bc + de] + table[c + d_f] - split - self._plain(" ")

    def mark(self, token: str) -> int:
        """Of a short word: the digit 2 if it is rare in the corpus, else 1."""
        t = token.strip(EDGES)
        if not t or not t.isalpha():
            return 49
        codes = [ord(c) - 96 if "a" <= c <= "z" else 27 for c in t]
        n = self.ones[codes[0]] if len(t) == 1 else self.twos[tuple(codes)] if len(t) == 2 else self.threes[tuple(c - 1 for c in codes)]
        return 50 if n < RARE * self.words else 49


class Known(dict):
    """What a function says of words, at most `most` of them at a time."""

    def __init__(self, tell: Callable[[str], object], most: int = 100_000):
        self.tell, self.most = tell, most

    def __missing__(self, word: str):
        if len(self) >= self.most:
            self.clear()
        got = self[word] = self.tell(word)
        return got


def join_gains(listed: list[str], decoder: Decoder) -> np.ndarray:
    """For every token but the first: how much likelier the text is if it is joined to the one
    before. Only the model's windows around the blank change, so this is the lattice's own
    comparison of the two readings."""
    out = []
    for a in range(1, len(listed), BLOCK):  # places a to b, with four tokens around for the windows
        first, b = max(a - 5, 0), min(a + BLOCK, len(listed))
        line = "   " + " ".join(listed[first : b + 4]) + "    "
        points = np.frombuffer(line.encode("utf-32-le", "replace"), np.uint32)
        codes = _POINTS[points]
        at = np.flatnonzero(points[3:-4] == 32) + 3
        out.append(decoder.gains(codes, at[a - 1 - first : b - 1 - first]))
    return np.concatenate(out)


def odd_spans(text: str, decoder: Decoder, with_pairs: bool = True) -> tuple[set[str], set[str], set[str]]:
    """The plain words of a text, its pairs of neighbours that may be one word, joined (both only as
    far as the third needs them, unless with_pairs), and what else the decoder should read: odd
    tokens, stretched words and runs of three words or more, or of short ones, that may be one."""
    listed = text.lower().split()
    raw = set(listed)
    words = {t for t in raw if t.isalpha()}
    spans: set[str] = set()
    if not text.isascii() and STRANGE.search(text):  # tokens that mix alphabets or hold characters without width
        spans.update(t for t in raw if STRANGE.search(t) and LATIN.fullmatch(t.strip(EDGES)))
    for t in raw - words:
        t = t.strip(EDGES)
        if t.isalpha():
            words.add(t)
        elif t:
            if with_pairs:
                words.update(p for p in PARTS.split(t) if p.isalpha())
            bare = t.rstrip(TAIL)
            if bare.isalpha():
                words.add(bare)
            elif ODD.search(bare) and (any(map(str.isalpha, bare)) or SYMBOL.search(bare) and len(set(bare)) > 1):
                spans.add(bare)
    data = np.frombuffer("\n".join(words).encode("utf-32-le", "replace"), np.uint32)
    if len(data) > 2 and ((data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])).any():
        spans.update(w for w in words if STRETCH.search(w))
    pairs: set[str] = set()
    if len(listed) > 1:
        gains = join_gains(listed, decoder)
        if with_pairs:
            pairs = {(listed[k] + listed[k + 1]).strip(EDGES) for k in np.flatnonzero(gains > SPLIT).tolist()}
        joins = gains + decoder.price > 0
        joins &= np.r_[False, joins[:-1]] | np.r_[joins[1:], False]  # pairs are read above
        short = np.fromiter(map(len, listed), np.int64, len(listed)) <= SHORT
        near = short[1:] & short[:-1]
        short &= np.r_[near, False] | np.r_[False, near]  # those beside another short one
        marks = np.full(len(listed), 48, np.uint8)
        at = np.flatnonzero(short).tolist()
        known = decoder.marks
        marks[at] = [known[listed[k]] for k in at]
        if (marks == 50).any():
            for m in UNLIKELY.finditer(marks.tobytes().decode()):
                a, b = m.start(), m.end() - 1
                if b > a + 1 and gains[a:b].max() > SPLIT or DIGIT.search(" ".join(listed[a : b + 1])):
                    joins[a:b] = True
        edges = np.flatnonzero(np.diff(np.r_[False, joins, False].astype(np.int8)))
        spans.update(" ".join(listed[a : b + 1]) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()))
    return words, pairs, spans


def read(text: str, decoder: Decoder) -> tuple[set[str], set[str]]:
    """The words of a text with those of the readings of its odd spans, and its joined pairs."""
    words, pairs, spans = odd_spans(text, decoder)
    for span in spans:
        for reading in decoder.restore(span)[0]:
            words.update(w for w in reading.split() if w.isalpha())
    return words, pairs


def tokens(text: str, decoder: Decoder) -> set[str]:
    """All words of a text and of its readings."""
    return set.union(*read(text, decoder))


def channel_counts(docs: DataFrame, win: np.ndarray, n: np.ndarray) -> dict[str, int]:
    """How often the likeliest readings of all documents used each reading of a character: a few
    names, whatever the corpus."""
    tables = docs.sparkSession.sparkContext.broadcast((win, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, used = Decoder(*tables.value), Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for span in odd_spans(t or "", decoder, False)[2]:
                    used.update(decoder.restore(span)[1])
        yield pa.RecordBatch.from_arrays([pa.array(list(used), pa.string()), pa.array(list(used.values()), pa.int64())], names=["name", "n"])

    rows = docs.select("text").mapInArrow(run, "name string, n bigint").groupBy("name").agg(F.sum("n").alias("n"))
    return {r.name: r.n for r in rows.collect()}  # at most a few for each character that has readings


STARTS = (4, 5, 6, 7)


def features(words: set[str], pairs: set[str] = frozenset()) -> set[str]:
    """Whole words, joined pairs as whole words, the words' beginnings of four to seven letters
    (led by ^), and beginnings that two words or more share (led by +)."""
    out = words | pairs
    for k in STARTS:
        starts = Counter([w[:k] for w in words if len(w) > k])
        out.update(["^" + s for s in starts])
        out.update(["+" + s for s, n in starts.items() if n > 1])
    return out


def fit_logistic(rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int, y: np.ndarray, ridge: float = 0.5, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights (none below zero) and bias of a logistic model over binary features, by Adam
    steps; rows of the rarer class weigh by the square root of the classes' ratio."""
    n_pos = y.sum()
    ratio = np.sqrt((n_rows - n_pos) / max(n_pos, 1))
    weight = np.where(y > 0, max(ratio, 1), max(1 / ratio, 1)) if ratio > 0 else np.ones(n_rows)
    w, m, v = (np.zeros(n_cols + 1) for _ in range(3))
    for step in range(1, steps + 1):
        z = np.bincount(rows, w[cols], n_rows) + w[-1]
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        g = np.r_[np.bincount(cols, e[rows], n_cols) + ridge * w[:-1], e.sum()] / n_rows
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-12)
        w[:-1] = np.maximum(w[:-1], 0)
    return w[:-1], float(w[-1])


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """doc_id, text, label of the rows to learn from: crc32(doc_id) mod 5 is not 0, at most
    max_rows of them by a hash of doc_id, of several documents with one id that with the least
    hash. The labels are broadcast, as max_rows bounds them: the documents stay where they are."""
    marks = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    marks = marks.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    met = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(marks), "doc_id")
    return met.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label")).alias("r")).select("doc_id", "r.text", "r.label")


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


class ToxicityModel:
    """The decoder's tables and the classifier's weights: bounded by the alphabet and by
    max_features."""

    def __init__(self, win: np.ndarray, n: np.ndarray, used: dict[str, int], weights: dict[str, float], bias: float):
        self.win, self.n, self.used, self.weights, self.bias = win, n, used, weights, bias
        self._decoder = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_words", "_first", "_starts")} | {"_decoder": None}

    @property
    def decoder(self) -> Decoder:
        if self._decoder is None:
            self._decoder = Decoder(self.win, self.n, self.used, ODDS)
            self._words = {f for f in self.weights if f[0] not in "^+"}
            self._first = {f[1 : STARTS[0] + 1] for f in self.weights if f[0] in "^+"}
            self._starts = {k: {f[1:] for f in self.weights if f[0] in "^+" and len(f) == k + 1} for k in STARTS}
        return self._decoder

    def score(self, text: str) -> float:
        words, pairs = read(text, self.decoder)
        got = words & self._words
        got |= pairs & self._words
        first = self._first
        begun = [w for w in words if w[: STARTS[0]] in first]
        for k, known in self._starts.items():
            starts = [s for s in [w[:k] for w in begun if len(w) > k] if s in known]
            if starts:
                got.update(["^" + s for s in starts])
                got.update(["+" + s for s, n in Counter(starts).items() if n > 1])
        got &= self.weights.keys()
        z = self.bias + sum(self.weights[f] for f in got)
        return float(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_features: int = 3000, min_docs: int = 4, min_share: float = 0.01) -> ToxicityModel:
    chars = character_counts(docs).toPandas()  # at most 28**4 + 256 rows
    win, n = chars["win"].to_numpy(np.int64), chars["n"].to_numpy(np.int64)
    used = channel_counts(docs, win, n)
    empty = ToxicityModel(win, n, used, {}, -30.0)
    tables = docs.sparkSession.sparkContext.broadcast((win, n, used))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(*tables.value, ODDS)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                f = [sorted(features(*read(t or "", decoder))) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(f, pa.list_(pa.string()))], names=["doc_id", "label", "f"])

    bags = cut(labelled(docs, labels, "toxic", max_rows).select("doc_id", "text", "label").mapInArrow(run, "doc_id bigint, label int, f array<string>"), "bags")
    n_rows, n_pos = bags.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n_rows or n_pos in (0, n_rows):
        share = n_pos / n_rows if n_rows else 0.0
        empty.bias = log(max(share, 1e-9) / max(1 - share, 1e-9))
        return empty
    counts = bags.select("label", F.explode("f").alias("f")).groupBy("f").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    odds = (F.col("pos") + 0.1) / n_pos / ((F.col("neg") + 0.5) / (n_rows - n_pos))
    best = counts.where((F.col("pos") >= max(min_docs, min_share * n_pos)) & (odds > 6)).orderBy((F.col("pos") * F.log(odds)).desc(), "f").limit(max_features)
    names = [r.f for r in best.select("f").collect()]  # at most max_features
    if not names:
        empty.bias = log(n_pos / (n_rows - n_pos))
        return empty
    index = F.broadcast(docs.sparkSession.createDataFrame(list(enumerate(names)), "i int, f string"))
    hits = bags.select("doc_id", "label", F.explode("f").alias("f")).join(index, "f").groupBy("doc_id", "label").agg(F.collect_list("i").alias("i"))
    got = hits.collect()  # of at most max_rows rows
    rows = np.concatenate([np.full(len(r.i), j) for j, r in enumerate(got)]) if got else np.zeros(0, int)
    cols = np.concatenate([np.array(r.i) for r in got]) if got else np.zeros(0, int)
    y = np.zeros(n_rows)
    y[: len(got)] = [r.label for r in got]
    y[len(got) : len(got) + int(n_pos - y.sum())] = 1  # rows without any feature
    w, b = fit_logistic(rows, cols, n_rows, len(names), y)
    return ToxicityModel(win, n, used, {f: float(x) for f, x in zip(names, w) if x > 1e-4}, float(b))


def scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            got = [model.score(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = scores(docs, fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with their columns."""
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        return pd.Series([shared.value.score(t or "") for t in texts], dtype="float64")

    return docs.where(score("text") < threshold)
