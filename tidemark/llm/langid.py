"""Language by piece unigrams: a text's score in a language is the sum over all segmentations.

The pieces are those of a fixed public vocabulary that consist of letters, and its bytes. In each
language every piece has a probability; a word's is the sum, over all ways to cut it into pieces,
of the product of theirs, by the forward algorithm in logarithms; a text's words are independent.
Pieces' probabilities are fitted by expectation maximisation: expected counts over all
segmentations of all words of the training texts, weighed by how often they occur. Words are
counted by language in Spark first, so a round costs one pass over different words.

Words are runs of letters, lower-cased, behind the vocabulary's word mark. A code point that is no
piece is its UTF-8 bytes, each a piece. The score is the language's posterior, with the languages'
shares of the training texts as priors. The model has a number a piece and language: it is
broadcast, its size bound by the vocabulary and `most_languages`, beyond which an error is raised.

Null texts and texts without a letter are `und` with score 0, and so is every text where nothing
could be learned; a null id counts as the empty string, rows with null lang are not learned from;
repeated rows have a row each; languages that score alike go by code-point order; extra columns
are not looked at; an empty table gives no rows. Very long texts and words are scored whole, in
bounded memory.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import spread
from .common import cut
from .fim import groups

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # the vocabulary's word mark
WORDS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
#: Least log probability of a code point that is no piece.
FLOOR = -30.0
NONE = -1e30
RESCALE = 16
GROUP_BYTES = 4 << 20
CACHED_NUMBERS = 1 << 22


def pieces(path: str = VOCABULARY) -> dict[str, int]:
    """Letter pieces of the vocabulary, with or without the word mark, from 256 on: 0 to 255 are bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    letters = sorted({n for n in names if n == n.lower() and WORDS.fullmatch(n.removeprefix(MARK) or "a")})
    return {n: i for i, n in enumerate(letters, 256)}


class Trie:
    """Pieces by their code points: an edge is its node's number and a code point in one integer."""

    def __init__(self, known: dict[str, int]):
        nodes, self.none = {"": 0}, 256 + len(known)
        for piece in known:
            for k in range(1, len(piece) + 1):
                nodes.setdefault(piece[:k], len(nodes))
        edges = sorted((nodes[x[:-1]] << 21 | ord(x[-1]), at) for x, at in nodes.items() if x)
        self.edges = np.array([e for e, _ in edges] or [-1], np.int64)
        self.to = np.array([at for _, at in edges] or [0], np.int64)
        self.piece = np.array([known.get(x, self.none) for x in nodes], np.int32)
        self.longest = max(map(len, known), default=1)


@dataclass
class Lattice:
    """Words of one length: which piece ends at each place with which length."""

    ids: np.ndarray  # words, places, lengths up to the longest: row of the table of probabilities
    spare: list[tuple[int, int, bytes]]  # word, place, bytes of a code point that is no piece
    none: int  # the row of no piece


def lattice(words: list[str], trie: Trie) -> Lattice:
    """All places of all words walk down the trie at once, until none is left on it."""
    m, n = len(words), len(words[0])
    longest = min(trie.longest, n)
    ids = np.full((m, n, longest), trie.none, np.int32)
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64).reshape(m, n)
    word, start = (x.ravel() for x in np.indices((m, n)))
    node = np.zeros(m * n, np.int64)
    for k in range(longest):
        edge = node << 21 | points[word, start + k]
        at = np.minimum(np.searchsorted(trie.edges, edge), len(trie.edges) - 1)
        on = trie.edges[at] == edge
        word, start, node = word[on], start[on], trie.to[at[on]]
        ids[word, start + k, k] = trie.piece[node]
        on = start + k + 1 < n
        word, start, node = word[on], start[on], node[on]
    spare = [(i, j, words[i][j].encode("utf-8", "surrogatepass")) for i, j in np.argwhere(ids[:, :, 0] == trie.none).tolist()]
    return Lattice(ids, spare, trie.none)


def spare_edges(found: Lattice, logp: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """place: words and log probabilities of code points that are no piece."""
    by: dict[int, tuple[list, list]] = {}
    for i, j, raw in found.spare:
        at = by.setdefault(j, ([], []))
        at[0].append(i)
        at[1].append(np.maximum(logp[list(raw)].sum(0), FLOOR))
    return {j: (np.array(i), np.array(p)) for j, (i, p) in by.items()}


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))


def _edges(found: Lattice) -> tuple[np.ndarray, ...]:
    """word, end, length less one and piece of all pieces in the lattice, by end and word."""
    m, n, longest = found.ids.shape
    none = found.none
    ids = found.ids
    if found.spare:  # an edge for each, whose probability is put in place by the caller
        ids = ids.copy()
        at = np.array([(i, j) for i, j, _ in found.spare])
        ids[at[:, 0], at[:, 1], 0] = -1
    end, word, back = np.nonzero(ids.transpose(1, 0, 2) != none)
    return word, end, back, ids[word, end, back]


def forward(found: Lattice, logp: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, summed over its segmentations. logp has a row
    a piece and a last one for none.

    Sums run over the pieces that are there, in plain numbers; every RESCALE places those still
    needed are divided by the last, so that words of any length stay in range."""
    m, n, longest = found.ids.shape
    word, end, back, piece = _edges(found)
    p = np.exp(logp[piece])
    if found.spare:
        p[piece == -1] = np.exp([np.maximum(logp[list(raw)].sum(0), FLOOR) for _, _, raw in sorted(found.spare, key=lambda x: (x[1], x[0]))])
    first = np.flatnonzero(np.diff(end * m + word, prepend=-1))  # every word has a piece at every end
    parts = np.searchsorted(end[first], np.arange(n + 1))
    sums, scale = np.zeros((n + 1, m, logp.shape[1])), np.zeros((m, logp.shape[1]))
    sums[0] = 1.0
    bounds = np.append(first, len(end))[parts].tolist()
    for j in range(n):
        a, b = bounds[j], bounds[j + 1]
        sums[j + 1] = np.add.reduceat(sums[j - back[a:b], word[a:b]] * p[a:b], first[parts[j] : parts[j + 1]] - a, axis=0)
        if (j + 1) % RESCALE == 0:
            last = sums[j + 1].copy()
            sums[max(0, j + 2 - longest) : j + 2] /= last
            scale += np.log(last)
    return scale + np.log(sums[n])


def beginnings(found: Lattice, logp: np.ndarray) -> np.ndarray:
    """Log probability of each beginning of each word in one language: words, places + 1."""
    m, n, longest = found.ids.shape
    spare = spare_edges(found, logp)
    out = np.full((m, n + 1), NONE)
    out[:, 0] = 0.0
    for j in range(n):
        k = np.arange(min(longest, j + 1))
        edges = logp[found.ids[:, j, k], 0]
        if j in spare:
            edges[spare[j][0], 0] = spare[j][1][:, 0]
        out[:, j + 1] = _log_sum(out[:, j - k] + edges, 1)
    return out


def _expected_short(found: Lattice, logp: np.ndarray, weights: np.ndarray, into: np.ndarray) -> None:
    """expected() for words so short that plain numbers do."""
    m, n, _ = found.ids.shape
    word, end, back, piece = _edges(found)
    p, spare = np.exp(logp[piece, 0]), sorted(found.spare, key=lambda x: (x[1], x[0]))
    if spare:
        p[piece == -1] = np.exp([max(logp[list(raw), 0].sum(), FLOOR) for _, _, raw in spare])
    start = end - back
    before, after = np.ones((n + 1, m)), np.ones((n + 1, m))
    # every word has a piece that ends, and one that starts, at every place
    first, by_start = np.flatnonzero(np.diff(end * m + word, prepend=-1)), np.argsort(start * m + word, kind="stable")
    last = np.flatnonzero(np.diff((start * m + word)[by_start], prepend=-1))
    ends, starts = np.append(first, len(end)), np.append(last, len(end))
    for j in range(n):
        at = slice(ends[j * m], ends[(j + 1) * m])
        before[j + 1] = np.add.reduceat(before[start[at], word[at]] * p[at], first[j * m : (j + 1) * m] - ends[j * m])
    for j in range(n - 1, -1, -1):
        at = by_start[starts[j * m] : starts[(j + 1) * m]]
        after[j] = np.add.reduceat(after[end[at] + 1, word[at]] * p[at], last[j * m : (j + 1) * m] - starts[j * m])
    share = before[start, word] * p * after[end + 1, word] / before[n, word] * weights[word]
    known = piece >= 0
    into += np.bincount(piece[known], share[known], len(into))
    for (_, _, raw), x in zip(spare, share[~known]):
        np.add.at(into, list(raw), x)


def expected(found: Lattice, logp: np.ndarray, weights: np.ndarray, into: np.ndarray) -> None:
    """Adds the expected counts of the pieces of words in one language (logp has one column)."""
    if found.ids.shape[1] <= RESCALE:
        _expected_short(found, logp, weights, into)
        return
    m, n, longest = found.ids.shape
    before = beginnings(found, logp)
    spare = spare_edges(found, logp)
    after = np.full((m, n + 1), NONE)
    after[:, n] = 0.0
    edges = logp[found.ids, 0]
    for j, (i, p) in spare.items():
        edges[i, j, 0] = p[:, 0]
    for j in range(n - 1, -1, -1):  # pieces that start at j end at j + k
        k = np.arange(min(longest, n - j))
        after[:, j] = _log_sum(edges[:, j + k, k] + after[:, j + k + 1], 1)
    total = before[:, n]
    for k in range(longest):
        j = np.arange(k, n)
        share = np.exp(before[:, j - k] + edges[:, j, k] + after[:, j + 1] - total[:, None]) * weights[:, None]
        np.add.at(into, found.ids[:, j, k].ravel(), share.ravel())
        if k == 0:
            for i, place, raw in found.spare:
                np.add.at(into, list(raw), share[i, place])
    into[-1] = 0.0


def _by_length(words: list[str], longest: int, languages: int) -> Iterator[list[int]]:
    """Places of words of one length, so many at a time that their lattices stay small."""
    by: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by.setdefault(len(w), []).append(i)
    for n, some in by.items():
        step = max(1, (1 << 21) // (n * min(n, longest) * max(1, languages // 4)))
        yield from (some[a : a + step] for a in range(0, len(some), step))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n of the texts of docs (lang not null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in groups(pc.binary_length(batch.column(1)).to_pylist(), GROUP_BYTES):
                count: dict[str, Counter] = {}
                for lang, text in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), batch.column(1).slice(lo, hi - lo).to_pylist()):
                    count.setdefault(lang, Counter()).update(WORDS.findall(text.lower()))
                for lang, words in count.items():
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["lang", "word", "n"])

    parts = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(run, "lang string, word string, n bigint")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    trie: Trie
    languages: list[str]
    logp: np.ndarray  # a row a byte and piece, the last for none; a column a language
    prior: np.ndarray
    name: str = ""

    def __post_init__(self):
        self.name = self.name or uuid.uuid4().hex

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row a word: its log probability in each language."""
        out = np.zeros((len(words), len(self.languages)))
        marked = [MARK + w for w in words]
        for some in _by_length(marked, self.trie.longest, len(self.languages)):
            found = lattice([marked[i] for i in some], self.trie)
            step = max(1, (1 << 23) // (len(some) * (found.ids.shape[1] + 1)))  # languages at a time
            for g in range(0, len(self.languages), step):
                out[some, g : g + step] = forward(found, self.logp[:, g : g + step])
        return out


def _table(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of counts (a row a piece, the last none), half a count added to each."""
    logp = np.log(counts + 0.5) - np.log((counts[:-1] + 0.5).sum(0))
    logp[-1] = NONE
    return logp


def fit(docs: DataFrame, rounds: int = 3, vocabulary: str = VOCABULARY, most_languages: int = 500) -> Model:
    """A model of all texts of docs by their lang; null langs are left out."""
    trie = Trie(pieces(vocabulary))
    size = trie.none + 1
    shares = docs.where("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(most_languages + 1).collect()
    if len(shares) > most_languages:
        raise ValueError(f"over {most_languages} languages")
    languages = sorted(r.lang for r in shares)
    prior = np.log([r.n for r in sorted(shares, key=lambda r: r.lang)]) - np.log(sum(r.n for r in shares)) if shares else np.zeros(0)
    counts, place = np.zeros((size, len(languages))), {g: i for i, g in enumerate(languages)}
    words, way = cut(word_counts(docs), "words") if languages else None, docs.sparkSession.sparkContext.broadcast(trie)
    for _ in range(rounds if languages else 0):
        shared = docs.sparkSession.sparkContext.broadcast(_table(counts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            into: dict[int, np.ndarray] = {}
            for batch in batches:
                by: dict[int, tuple[list, list]] = {}
                for g, w, n in zip(*(c.to_pylist() for c in batch.columns)):
                    at = by.setdefault(place[g], ([], []))
                    at[0].append(MARK + w)
                    at[1].append(n)
                for g, (some, n) in by.items():
                    weights, logp = np.array(n, float), shared.value[:, [g]]
                    sums = into.setdefault(g, np.zeros(size))
                    for part in _by_length(some, way.value.longest, 1):
                        expected(lattice([some[i] for i in part], way.value), logp, weights[part], sums)
            for g, sums in into.items():
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), g, np.int32)), pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["g", "piece", "n"])

        got = spread(words).mapInArrow(run, "g int, piece int, n double").groupBy("g", "piece").agg(F.sum("n").alias("n")).toArrow()  # at most pieces times languages
        counts = np.zeros_like(counts)
        counts[got["piece"].to_numpy(), got["g"].to_numpy()] = got["n"].to_numpy()
        shared.destroy()
    return Model(trie, languages, _table(counts), prior)


class Scores:
    """A model's word scores, kept by a worker from task to task, up to a number of words."""

    def __init__(self, model: Model):
        self.name, self.most = model.name, max(1, CACHED_NUMBERS // max(1, len(model.languages)))
        self.at: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages)))

    def add(self, words: set[str], model: Model) -> None:
        fresh = [w for w in words if w not in self.at]
        if fresh and len(self.at) + len(fresh) > self.most:
            self.at, self.rows, fresh = {}, self.rows[:0], list(words)
        if fresh:
            self.at.update(zip(fresh, range(len(self.rows), len(self.rows) + len(fresh))))
            self.rows = np.concatenate([self.rows, model.word_scores(fresh)])


_scores: Scores | None = None


def text_scores(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of each text in each language, and whether it has a letter."""
    global _scores
    if _scores is None or _scores.name != model.name:
        _scores = Scores(model)
    counts = [Counter(WORDS.findall(t.lower())) if t else Counter() for t in texts]
    _scores.add(set().union(*counts), model)
    out = np.zeros((len(texts), len(model.languages)))
    for i, c in enumerate(counts):
        if c:
            out[i] = np.fromiter(c.values(), float, len(c)) @ _scores.rows[list(map(_scores.at.__getitem__, c))]
    return out, np.fromiter(map(bool, counts), bool, len(texts))


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, lang_pred and score (its posterior) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for lo, hi in groups(sizes, GROUP_BYTES):
                part = batch.slice(lo, hi - lo)
                names, best = [UNDETERMINED] * len(part), np.zeros(len(part))
                if model.languages:
                    x, lettered = text_scores(part.column(1).to_pylist(), model)
                    x = x + model.prior
                    at = x.argmax(1)
                    share = 1.0 / np.exp(x - x.max(1)[:, None]).sum(1)
                    names = [model.languages[a] if some else UNDETERMINED for a, some in zip(at.tolist(), lettered.tolist())]
                    best = np.where(lettered, share, 0.0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(best, pa.float64())], names=[key, "lang_pred", "score"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def language_digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that are not held out."""
    model = fit(docs.where(~held_out()).select("lang", "text"))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
