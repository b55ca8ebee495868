"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is a node with two labels, bad and good. Its features describe the line
and its neighbours (letters, capitals, digits, symbols, word lengths, repetition inside the
line and among the lines). Forward-backward gives each line's marginal of `good`; their mean,
weighted by length, is the document's score.

Lines take their document's label in training, on at most `max_rows` labelled rows in the order
of a hash of doc_id and at most `max_lines` lines of theirs. Features are made and scored a block
of lines at a time, so that a text of very many lines needs a few numbers a line only.

Null and empty texts have one empty line; null labels and ids without a document are not
used; several labels of an id count as good if one is; of several documents with one id the one
with the least hash is learned from; without labels of both classes every score is the share of
good ones (0 if none); no documents give no rows; repeated rows are scored each for itself;
extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, utf8
from .toxicity import held_out, labelled

_UPPER, _LOWER, _DIGIT, _SPACE, _HIGH, _SYMBOL = range(6)
_CLASS = np.full(256, _SYMBOL, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_PROSE = np.zeros(256, bool)
_PROSE[[ord(c) for c in ".,;:'\"-?"]] = True
OWN = 15  # features of a line; its neighbours' are added
N_FEATURES = 1 + 3 * OWN + 2
BLOCK = 4096  # lines


def _own_features(lines: list[bytes], same: Counter, seen: set[bytes]) -> np.ndarray:
    """The features of lines by themselves and by the lines before them (seen holds their words)."""
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    starts = np.cumsum(lengths + 1) - lengths - 1
    kinds = _CLASS[data]
    n = np.maximum(lengths, 1).astype(float)
    share = [np.add.reduceat(kinds == k, starts, dtype=np.int64) / n for k in range(6)]
    prose = np.add.reduceat(_PROSE[data], starts, dtype=np.int64) / n
    own = np.zeros((len(lines), OWN))
    for i, line in enumerate(lines):
        words = line.split()
        if words:
            unique = set(words)
            pairs = set(zip(words, words[1:]))
            own[i, 7] = 1 - len(unique) / len(words)
            own[i, 8] = 1 - len(pairs) / max(1, len(words) - 1) if len(words) > 1 else 0
            own[i, 14] = sum(map(eq, words, words[1:])) / len(words)
            own[i, 9] = min(2.0, len(line) / len(words) / 8)
            own[i, 13] = len(unique & seen) / len(unique) if len(seen) else 0
            seen |= unique
        own[i, 10] = 1.0 if same[line] > 1 and line else 0.0
    own[:, 0] = share[_UPPER]
    own[:, 1] = share[_DIGIT]
    own[:, 2] = np.maximum(share[_SYMBOL] - prose, 0)
    own[:, 3] = share[_LOWER] + share[_HIGH]
    own[:, 4] = share[_SPACE]
    own[:, 5] = prose
    own[:, 6] = np.minimum(np.log1p(lengths) / 8, 2)
    own[:, 11] = np.fromiter((line.count(b"|") for line in lines), float, len(lines)) * 8 / n
    own[:, 12] = np.fromiter((line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines), float, len(lines))
    return own


def feature_blocks(text: bytes, block: int = BLOCK) -> Iterator[np.ndarray]:
    """The rows of features of a text's lines, a block of lines at a time."""
    lines = text.split(b"\n")
    same, seen = Counter(lines), set()
    before, own = np.zeros((1, OWN)), _own_features(lines[:block], same, seen)
    for at in range(0, len(lines), block):
        following = _own_features(lines[at + block : at + 2 * block], same, seen) if at + block < len(lines) else None
        after = np.zeros((1, OWN)) if following is None else following[:1]
        m = len(own)
        first, last = np.zeros((m, 1)), np.zeros((m, 1))
        first[0], last[-1] = at == 0, following is None
        yield np.hstack([np.ones((m, 1)), own, np.vstack([before, own[:-1]]), np.vstack([own[1:], after]), first, last])
        before, own = own[-1:], following


def line_features(text: bytes) -> np.ndarray:
    """A row of features for every line."""
    return np.vstack(list(feature_blocks(text)))


def good_marginals(scores: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The marginal of `good` of every node of one chain, by forward-backward sums that are scaled
    at each node. scores: of good against bad; trans: (2, 2)."""
    n = len(scores)
    grown = np.exp(np.clip(scores, -300, 300)).tolist()
    (bb, bg), (gb, gg) = np.exp(trans - trans.max()).tolist()
    ahead, back = np.empty(n), np.empty(n)  # shares of good
    good = 0.0
    for i, e in enumerate(grown):
        g = e * (1.0 if i == 0 else (1 - good) * bg + good * gg)
        b = 1.0 if i == 0 else (1 - good) * bb + good * gb
        good = g / (g + b)
        ahead[i] = good
    good = 0.5
    for i in range(n - 1, -1, -1):
        back[i] = good
        e = grown[i] * good
        g, b = gb * (1 - good) + gg * e, bb * (1 - good) + bg * e
        good = g / (g + b)
    both = ahead * back
    return both / (both + (1 - ahead) * (1 - back))


def _batched(scores: np.ndarray, mask: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node marginals (d, n, 2) and summed edge marginals (d, 2, 2) of many chains padded to one
    length: scores (d, n, 2), mask (d, n), trans (2, 2)."""
    d, n, _ = scores.shape
    alpha, beta = np.zeros((d, n, 2)), np.zeros((d, n, 2))
    alpha[:, 0] = scores[:, 0]
    for i in range(1, n):
        step = scores[:, i] + np.logaddexp(alpha[:, i - 1, :1] + trans[0], alpha[:, i - 1, 1:] + trans[1])
        alpha[:, i] = np.where(mask[:, i, None], step, alpha[:, i - 1])
    for i in range(n - 2, -1, -1):
        nxt = scores[:, i + 1] + beta[:, i + 1]
        step = np.logaddexp(trans[None, :, 0] + nxt[:, :1], trans[None, :, 1] + nxt[:, 1:])
        beta[:, i] = np.where(mask[:, i + 1, None], step, 0)
    z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    node = np.exp(np.minimum(alpha + beta - z[:, None, None], 0)) * mask[..., None]
    edge = np.exp(np.minimum(alpha[:, :-1, :, None] + trans + (scores + beta)[:, 1:, None, :] - z[:, None, None, None], 0)) * mask[:, 1:, None, None]
    return node, edge.sum(1)


def fit_weights(chains: list[np.ndarray], labels: np.ndarray, ridge: float = 1.0, steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the label good against bad (f,) and transitions (2, 2), by accelerated
    gradient steps on the mean log likelihood of the chains; chains of the rarer class weigh
    by the square root of the classes' ratio."""
    order = np.argsort([len(c) for c in chains], kind="stable")
    groups = []
    for at in range(0, len(order), 256):
        own = order[at : at + 256]
        n = max(len(chains[i]) for i in own)
        x = np.zeros((len(own), n, N_FEATURES), np.float32)
        mask = np.zeros((len(own), n), bool)
        for j, i in enumerate(own):
            x[j, : len(chains[i])] = chains[i]
            mask[j, : len(chains[i])] = True
        groups.append((x, mask, labels[own]))
    heavy = np.sqrt(np.clip([(labels > 0).sum() / max(1, (labels == 0).sum()), (labels == 0).sum() / max(1, (labels > 0).sum())], 1, 100))
    total = sum(len(c) for c in chains)
    w, t = np.zeros(N_FEATURES), np.zeros((2, 2))
    vw, vt, rate = np.zeros_like(w), np.zeros_like(t), 0.5
    for _ in range(steps):
        gw, gt = -ridge * w, -ridge * t
        at_w, at_t = w + 0.9 * vw, t + 0.9 * vt
        for x, mask, y in groups:
            s = np.zeros((*mask.shape, 2))
            s[..., 1] = x @ at_w
            node, edge = _batched(s, mask, at_t)
            c = heavy[y.astype(int)]
            gw = gw + np.tensordot(x, c[:, None] * ((mask * y[:, None]) - node[..., 1]), ([0, 1], [0, 1]))
            pairs = mask[:, 1:].sum(1) * c
            gt = gt - (edge * c[:, None, None]).sum(0) + np.diag([(pairs * (1 - y)).sum(), (pairs * y).sum()])
        vw, vt = 0.9 * vw + rate * gw / total, 0.9 * vt + rate * gt / total
        w, t = w + vw, t + vt
    return w, t


class QualityModel:
    def __init__(self, weights: np.ndarray | None, trans: np.ndarray | None, share: float):
        self.weights, self.trans, self.share = weights, trans, share

    def lines(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The marginal of `good` and the length of every line."""
        lengths = np.fromiter(map(len, text.split(b"\n")), np.int64)
        if self.weights is None:
            return np.full(len(lengths), self.share), lengths
        return good_marginals(np.concatenate([x @ self.weights for x in feature_blocks(text)]), self.trans), lengths

    def score(self, text: bytes) -> float:
        good, lengths = self.lines(text)
        weight = lengths if lengths.sum() else lengths + 1
        return float(min(1.0, max(0.0, (good * weight).sum() / weight.sum())))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, max_lines: int = 200_000) -> QualityModel:
    """max_rows bounds the labelled rows, max_lines the lines of theirs that training reads
    (whole documents, in the order of a hash of doc_id, those that would pass the bound left
    out)."""
    sample = cut(labelled(docs, labels, "quality", max_rows).select("doc_id", utf8().alias("text"), "label"), "labelled")
    n_lines = F.length("text") - F.length(F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit("")).cast("binary")) + 1
    taken, n = {}, 0
    for r in sample.select("doc_id", n_lines.alias("n"), F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").collect():  # max_rows rows
        if n + r.n <= max_lines:
            taken[r.doc_id] = len(taken)
            n += r.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                x = line_features(text.as_py()).astype(np.float32).tobytes()
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([row.column(0), row.column(2), pa.array([x], pa.binary())], names=["doc_id", "label", "x"])

    got = sample.where(F.col("doc_id").isin(list(taken))).mapInArrow(run, "doc_id bigint, label int, x binary").collect()  # max_lines lines
    got.sort(key=lambda r: taken[r.doc_id])
    chains = [np.frombuffer(bytes(r.x), np.float32).reshape(-1, N_FEATURES) for r in got]
    y = np.array([r.label for r in got], float)
    if not len(y) or y.sum() in (0, len(y)):
        return QualityModel(None, None, float(y.mean()) if len(y) else 0.0)
    return QualityModel(*fit_weights(chains, y), float(y.mean()))


def scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text")).mapInArrow(run, "doc_id bigint, score double")


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = scores(docs, fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
