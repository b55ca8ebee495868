"""Fill-in-middle: each text is cut at two of its units and put together in another order.

Units are lines, `[^\\n]*\\n|[^\\n]+`, or code points. A group of texts is one array of bytes, seen
as 64-bit words: arithmetic on a word marks the bytes that end a unit, bitwise_count counts a
word's marks, and their running sum gives the marks before any byte (rank). The k-th mark is
found by a search of the running sums for its word, and in the word by the sums of its bytes'
marks (select), so that no text is split and a cut costs the same however many units a text has.

The draws come from sha256 of `<seed>:<id>`, so runs agree. Null texts are empty, empty texts and
those that hold a sentinel stay plain; a null id draws as the empty string; repeated rows and ids
have a row each, equal ones equal results; extra columns are not looked at; an empty table gives
no rows. Very long texts are groups of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import utf8

#: Sentinels of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
GROUP_BYTES = 8 << 20

_LOW, _ONES, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_U = np.uint64


def line_ends(w: np.ndarray) -> np.ndarray:
    """0x80 in each byte that is a line feed."""
    x = w ^ (_U(0x0A) * _ONES)
    return ~(((x & _LOW) + _LOW) | x | _LOW)


def inner_bytes(w: np.ndarray) -> np.ndarray:
    """0x80 in each byte that goes on with a code point (10xxxxxx)."""
    return w & (~w << _U(1)) & _HIGH


def char_ends(w: np.ndarray) -> np.ndarray:
    """0x80 in each byte after which no code point goes on."""
    starts = inner_bytes(w) ^ _HIGH
    return (starts >> _U(8)) | (np.append(starts[1:], _HIGH) << _U(56))


UNITS = {"line": line_ends, "char": char_ends}


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks, self.counts = marks, np.bitwise_count(marks).astype(np.int64)
        self.upto = np.cumsum(self.counts)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each place."""
        word = at >> 3
        before = self.marks[word] & ((_U(1) << (at & 7).astype(np.uint64) * _U(8)) - _U(1))
        return self.upto[word] - self.counts[word] + np.bitwise_count(before)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th marked byte, from 0."""
        word = np.searchsorted(self.upto, k, "right")
        left = k - (self.upto[word] - self.counts[word])
        sums = (self.marks[word] >> _U(7)) * _ONES  # byte i: marks of bytes 0 to i
        more = ((sums | _HIGH) - (left + 1).astype(np.uint64) * _ONES) & _HIGH  # bytes whose sum exceeds left
        return word * 8 + 8 - np.bitwise_count(more)


def places(texts: list[bytes], h1: np.ndarray, h2: np.ndarray, unit: str = "line") -> tuple[np.ndarray, ...]:
    """For each text: n units, the bytes at which its middle starts and ends, and the code points
    of its prefix and its middle."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    starts, total = ends - lengths, int(ends[-1]) if len(texts) else 0
    raw = np.zeros((total // 8 + 1) * 8, np.uint8)
    raw[:total] = np.frombuffer(b"".join(texts), np.uint8)
    words = raw.view("<u8")
    marked, inner = Marks(UNITS[unit](words)), Marks(inner_bytes(words))
    first = marked.rank(starts)
    # a text ends its last unit whether that byte is marked or not
    n = marked.rank(np.maximum(ends - 1, starts)) - first + (lengths > 0)
    a, b = h1 % (n + 1), h2 % (n + 1)

    def cut(k: np.ndarray) -> np.ndarray:
        at, some = np.where(k == n, ends, starts), (k > 0) & (k < n)
        at[some] = marked.select((first + k - 1)[some]) + 1
        return at

    x, y = cut(np.minimum(a, b)), cut(np.maximum(a, b))
    chars = lambda s, e: (e - s) - (inner.rank(e) - inner.rank(s))
    return n, x - starts, y - starts, chars(starts, x), chars(x, y)


def groups(sizes: list[int], most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many bytes together, or of one text."""
    a = total = 0
    for i, s in enumerate(sizes):
        if i > a and total + s > most:
            yield a, i
            a, total = i, 0
        total += s
    if a < len(sizes):
        yield a, len(sizes)


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, unit: str = "line", rate: int = 100, spm_rate: int = 50, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """The key with n (units), form (plain, psm or spm), prefix_chars, middle_chars (code points;
    null if plain) and output. rate % of the texts are cut, spm_rate % of those start with the suffix."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]
    p, s, m = (x.encode() for x in sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_pylist()
            for lo, hi in groups(sizes):
                part = batch.slice(lo, hi - lo)
                texts = part.column(1).to_pylist()
                h = [part.column(2 + i).to_numpy() for i in range(4)]
                n, x, y, before, middle = places(texts, h[0], h[1], unit)
                plain = np.fromiter((not t or p in t or s in t or m in t for t in texts), bool, len(texts)) | (h[2] % 100 >= rate)
                swap = h[3] % 100 < spm_rate
                out, forms = [], []
                for t, a, b, asis, spm in zip(texts, x.tolist(), y.tolist(), plain.tolist(), swap.tolist()):
                    forms.append("plain" if asis else "spm" if spm else "psm")
                    out.append(t if asis else b"".join((s, t[b:], p, t[:a], m, t[a:b]) if spm else (p, t[:a], s, t[b:], m, t[a:b])))
                counts = [pa.array(c, pa.int64(), mask=plain) for c in (before, middle)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(forms), *counts, pa.array(out, pa.binary())], names=[key, "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema[key].dataType.simpleString()
    cut = docs.select(key, utf8(text).alias("t"), *draws).mapInArrow(run, f"`{key}` {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary")
    return cut.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of: its pieces hold no sentinel."""
    parts = F.split(output, "|".join(r"\Q" + x + r"\E" for x in sentinels), 4)
    first, second, last = parts[1], parts[2], parts[3]
    return F.when(form == "psm", F.concat(first, last, second)).when(form == "spm", F.concat(second, last, first)).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """fill_in_middle's rows with sha256 of the output and of the text restored from it."""
    made = fill_in_middle(docs)
    back = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(back.cast("binary"), 256).alias("restored_sha256"))
