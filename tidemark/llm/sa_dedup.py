"""Exact removal of repeated byte strings with suffix arrays built shard by shard.

A byte goes if a string of `size` bytes that covers it also starts earlier. Whether a start
is a repeat is decided where all equal strings meet:

1. Each window of `size` bytes is posted under its least hashed k-mer (its anchor). Equal
   windows have equal anchors. Neighbouring windows with one anchor form one stretch of at
   most 2 * size - k bytes, so a document posts about one row a 35 bytes.
2. Rows meet by anchor. Stretches that are alone under their anchor are done. Of stretches whose
   bytes have one 128-bit hash only the earliest goes on; all windows of the others are repeats.
3. Stretches that share an anchor but differ are read again and dealt by anchor into shards;
   each shard's suffix array is built by induced sorting, and permuted common prefixes of
   `size` or more tie equal windows; all but the earliest are repeats. Anchors with more than
   `hot` different stretches are dealt anew by longer k-mers (the steps above, over these
   stretches), until k is `size` and a shard holds nothing but one window's copies.
4. The repeats of a document, as ranges of window starts, are joined with its bytes.

Null texts are empty; texts shorter than `size` lose nothing. Order is by doc_id (null first),
then start. Rows that share a doc_id: equal rows are one document and get one result each;
different texts are documents of their own, in an order of their hashes and bytes. No documents
give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut, utf8
from .suffix_array import permuted_common_prefixes, suffix_array

PIECE = 1 << 19  # bytes that are hashed at a time
BASE = 0x9E3779B97F4A7C15 | 1
NO_ID = -(1 << 63)

STRETCH = "m bigint, s bigint, z bigint, doc bigint, copy int, pos int, n int"
COMMON = 20_000  # repeated stretches that a task remembers; others meet later
BUCKETS = 4096  # that the texts of one doc_id are numbered by


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Hasher:
    """Polynomial hashes of the k-mers of a buffer, by prefix sums modulo 2**64. They only place
    windows: equal k-mers have equal hashes."""

    def __init__(self, most: int):
        inverse = pow(BASE, -1, 1 << 64)
        self.up, self.down = (self._powers(b, most + 1) for b in (BASE, inverse))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        return np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)], dtype=np.uint64)

    def grams(self, x: np.ndarray, k: int) -> np.ndarray:
        sums = np.r_[np.uint64(0), np.cumsum((x.astype(np.uint64) + np.uint64(1)) * self.up[: len(x)], dtype=np.uint64)]
        n = len(x) - k + 1
        return _mix((sums[k:] - sums[:n]) * self.down[:n] + np.uint64(k))


def stretches(hasher: Hasher, x: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int, k: int) -> tuple[np.ndarray, ...]:
    """For pieces of a buffer: piece, first window, number of windows, anchor hash and the two
    halves of a 128-bit hash of the bytes of every stretch."""
    n = len(x)
    empty = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 3
    if n < size:
        return empty
    h = hasher.grams(x, k)
    grams = len(h)
    low = np.uint64((1 << 21) - 1)
    least = (h & ~low) | np.arange(grams, dtype=np.uint64)
    width = size - k + 1  # k-mers in a window
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: n - size + 1], least[width - span :][: n - size + 1])
    anchor = (least & low).astype(np.int64)
    count = np.maximum(lengths - size + 1, 0)
    piece = np.repeat(np.arange(len(starts)), count)
    at = np.repeat(starts - np.cumsum(count) + count, count) + np.arange(count.sum())
    if not len(at):
        return empty
    a = anchor[at]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (piece[1:] != piece[:-1])])
    number = np.diff(np.r_[first, len(at)])
    begin = at[first]
    data, digest = x.tobytes(), xxhash.xxh3_128_digest
    whole = np.frombuffer(b"".join([digest(data[i:j]) for i, j in zip(begin.tolist(), (begin + number - 1 + size).tolist())]), "<u8")
    return piece[first], begin, number, h[a[first]], whole[::2], whole[1::2]


def _pieces(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Buffers of about PIECE bytes: (doc, copy, place in the document, length) of what they
    hold, from rows of doc, copy, place, bytes. A long text is cut so that every window lies in
    one piece."""
    group: list[bytes] = []
    what: list[tuple[int, int, int, int]] = []
    held = 0
    for doc, copy, place, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
        for a in range(0, max(1, len(text) - size + 1), PIECE):
            part = text[a : a + PIECE + size - 1]
            if len(part) < size:
                continue
            if held and held + len(part) > PIECE:
                yield np.frombuffer(b"".join(group), np.uint8), what
                group, what, held = [], [], 0
            group.append(part)
            what.append((doc, copy, place + a, len(part)))
            held += len(part)
    if held:
        yield np.frombuffer(b"".join(group), np.uint8), what


def _stretch_batch(m, s, z, doc, copy, pos, n) -> pa.RecordBatch:
    kinds = (np.int64, np.int64, np.int64, np.int64, np.int32, np.int32, np.int32)
    cols = [np.ascontiguousarray(c).view(np.int64) if c.dtype == np.uint64 else c.astype(k) for c, k in zip((m, s, z, doc, copy, pos, n), kinds)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["m", "s", "z", "doc", "copy", "pos", "n"])


def _numbered(docs: DataFrame) -> DataFrame:
    """doc, copy, text (binary), times: copy tells texts of one doc_id apart; equal rows are one
    document, times says how many. Null ids are NO_ID with copies below zero, so they come first
    and are no other id's."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), F.col("doc_id").isNull().alias("lost"), utf8().alias("text"))
    copy = lambda n: F.when(F.col("lost"), n - F.lit(1 << 31)).otherwise(n).cast("int").alias("copy")
    shared = cut(rows.groupBy("doc", "lost").agg(F.count("*").alias("c")).where("c > 1").select("doc", "lost"), "shared")
    if not shared.limit(1).count():
        return rows.select("doc", copy(F.lit(0).cast("bigint")), "text", F.lit(1).alias("times"))
    alone = rows.join(shared, ["doc", "lost"], "left_anti").select("doc", copy(F.lit(0).cast("bigint")), "text", F.lit(1).alias("times"))
    # numbered within buckets of a hash of the text, then shifted: no id is one task's
    texts = cut(rows.join(shared, ["doc", "lost"], "left_semi").groupBy("doc", "lost", "text").agg(F.count("*").cast("int").alias("times")).withColumn("b", F.pmod(F.xxhash64("text"), F.lit(BUCKETS))), "texts")
    by = ["doc", "lost", "b"]
    before = W.partitionBy("doc", "lost").orderBy("b").rowsBetween(W.unboundedPreceding, 0)
    base = texts.groupBy(*by).agg(F.count("*").alias("c")).withColumn("base", F.sum("c").over(before) - F.col("c")).drop("c")
    placed = texts.withColumn("i", F.row_number().over(W.partitionBy(*by).orderBy("text")) - 1).join(base, by)
    return alone.unionByName(placed.select("doc", copy(F.col("base") + F.col("i")), "text", "times"))


def _posted(rows: DataFrame, size: int, k: int) -> DataFrame:
    """STRETCH rows of texts (doc, copy, place, bytes); what is found repeated already in a buffer
    comes as ranges with n below zero."""
    most = PIECE + 2 * size

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(2 * most)
        common: dict[tuple[int, int], tuple[int, int, int]] = {}  # where this task posted them first
        halves = np.zeros(0, np.uint64)
        for batch in batches:
            for x, what in _pieces(batch, size):
                doc, copy, place, length = (np.array(c) for c in zip(*what))
                starts = np.cumsum(length) - length
                piece, begin, number, m, s, z = stretches(hasher, x, starts, length, size, k)
                if not len(piece):
                    continue
                d, c, pos = doc[piece], copy[piece], begin - starts[piece] + place[piece]
                order = np.lexsort((pos, c, d, z, s, m))
                d, c, pos, number, m, s, z = (v[order] for v in (d, c, pos, number, m, s, z))
                # of stretches that are equal already here all but the earliest are repeats
                again = np.r_[False, (m[1:] == m[:-1]) & (s[1:] == s[:-1]) & (z[1:] == z[:-1])]
                # and of those that a buffer of this task has repeated, all but the earliest so far
                for i in np.flatnonzero(~again & (np.isin(s, halves) | np.r_[again[1:], False])).tolist():
                    key, place = (int(s[i]), int(z[i])), (int(d[i]), int(c[i]), int(pos[i]))
                    first = common.get(key)
                    if first and first <= place:
                        again[i] = True
                    elif first or len(common) < COMMON:
                        common[key] = place
                if len(halves) < len(common):
                    halves = np.array([k for k, _ in common], np.uint64)
                yield _stretch_batch(*(v[~again] for v in (m, s, z, d, c, pos, number)))
                if again.any():
                    yield _gone(d[again], c[again], pos[again], number[again])

    return rows.mapInArrow(post, STRETCH)


def _met(posted: DataFrame) -> DataFrame:
    """STRETCH rows where anchors meet: ranges of repeats (n below zero), and stretches that share
    their anchor with different ones."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last different stretch so far, and whether its anchor had another
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(7)]
            gone = cols[6] < 0
            if gone.any():
                yield _stretch_batch(*(v[gone] for v in cols))
                cols = [v[~gone] for v in cols]
            m, s, z, d, c, pos, n = cols
            if not len(m):
                continue
            first = np.r_[last != (m[0], s[0], z[0]), (m[1:] != m[:-1]) | (s[1:] != s[:-1]) | (z[1:] != z[:-1])]
            last = (m[-1], s[-1], z[-1])
            if not first.all():
                yield _gone(d[~first], c[~first], pos[~first], n[~first])
            cols = [v[first] for v in cols]
            mixed_before = False
            if held is not None:
                cols = [np.r_[h, v] for h, v in zip(held[0], cols)]
                mixed_before = held[1]
            m = cols[0]
            if not len(m):
                continue
            next_same = np.r_[m[1:] == m[:-1], False]
            mixed = next_same | np.r_[mixed_before, next_same[:-1]]
            out = np.flatnonzero(mixed[:-1])
            if len(out):
                yield _stretch_batch(*(v[out] for v in cols))
            held = [v[-1:] for v in cols], bool(mixed[-1])
        if held is not None and held[1]:
            yield _stretch_batch(*held[0])

    return cut(posted.repartition("m").sortWithinPartitions("m", "s", "z", "doc", "copy", "pos").mapInArrow(meet, STRETCH), "met")


def repeats(docs: DataFrame, size: int = 100, k: int = 32, hot: int = 500, shard_bytes: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """(ranges, packed): doc, copy, pos, n - windows pos .. pos + n - 1 of a document repeat
    earlier ones; doc, copy, z, times - the documents' bytes, compressed for shuffles, and their
    number of equal rows."""
    rows = _numbered(docs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([coder.compress(t) for t in batch.column(2).to_pylist()], pa.binary()), batch.column(3)], names=["doc", "copy", "z", "times"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decoder = zstandard.ZstdDecompressor()
            m, doc, copy, pos, bits, crowded = [], [], [], [], [], []
            for d, c, z, asks in zip(*(batch.column(i).to_pylist() for i in range(4))):
                text = decoder.decompress(z)
                for a in asks:
                    m.append(a["m"])
                    doc.append(d)
                    copy.append(c)
                    pos.append(a["pos"])
                    bits.append(text[a["pos"] : a["pos"] + a["n"] - 1 + size])
                    crowded.append(a["hot"])
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((m, doc, copy, pos, bits, crowded), kinds)], names=["m", "doc", "copy", "pos", "bytes", "hot"])

    packed = rows.mapInArrow(pack, "doc bigint, copy int, z binary, times int")
    texts = rows.select("doc", "copy", F.lit(0).alias("pos"), "text")
    ranges = None
    while True:
        met = _met(_posted(texts, size, k))
        mixed = met.where("n > 0").select("m", "doc", "copy", "pos", "n")
        crowded = mixed.groupBy("m").agg(F.count("*").alias("c")).where(F.col("c") > (hot if k < size else 1 << 62)).select("m", F.lit(True).alias("hot"))
        # the crowded anchors are at most 1 / hot of the stretches: none or few, else joined by a shuffle
        crowded = cut(crowded, "crowded")
        n_crowded = crowded.count()
        mixed = mixed.join(F.broadcast(crowded) if n_crowded <= 500_000 else crowded, "m", "left") if n_crowded else mixed.withColumn("hot", F.lit(False))
        asked = mixed.groupBy("doc", "copy").agg(F.collect_list(F.struct("m", "pos", "n", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("a"))
        fetched = packed.drop("times").join(asked, ["doc", "copy"]).mapInArrow(fetch, "m bigint, doc bigint, copy int, pos int, bytes binary, hot boolean")
        if n_crowded:
            fetched = cut(fetched, "fetched")
        found = met.where("n < 0").select("doc", "copy", "pos", (-F.col("n")).alias("n")).unionByName(_sorted(fetched.where("not hot"), size, shard_bytes))
        ranges = found if ranges is None else ranges.unionByName(found)
        if not n_crowded:
            return ranges, packed
        texts = fetched.where("hot").select("doc", "copy", "pos", "bytes")
        k = min(size, k * 2 if k * 2 < size else size if k > size - 8 else size - 4)


def _sorted(stretches_: DataFrame, size: int, shard_bytes: int) -> DataFrame:
    """doc, copy, pos, n: repeats among stretches, whole anchors dealt into shards."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .ann import _whole_groups

        for batch in _whole_groups(batches):
            m = batch.column(0).to_numpy()
            ends = np.r_[np.flatnonzero(m[1:] != m[:-1]) + 1, len(m)]  # of anchors
            upto = pa.compute.binary_length(batch.column(4)).to_numpy().cumsum()[ends - 1]
            at = done = 0
            while at < len(m):
                last = max(int(np.searchsorted(upto, done + shard_bytes, "right")) - 1, int(np.searchsorted(ends, at, "right")))
                yield from shard_repeats(batch.slice(at, int(ends[last]) - at), size)
                at, done = int(ends[last]), int(upto[last])

    return stretches_.select("m", "doc", "copy", "pos", "bytes").repartition("m").sortWithinPartitions("m").mapInArrow(sort, "doc bigint, copy int, pos int, n int")


def _gone(d: np.ndarray, c: np.ndarray, pos: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Ranges of repeats, neighbours joined; n is negative, and m spreads them evenly."""
    order = np.lexsort((pos, c, d))
    d, c, pos, n = d[order], c[order], pos[order].astype(np.int64), n[order].astype(np.int64)
    new = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (c[1:] != c[:-1]) | (pos[1:] != pos[:-1] + n[:-1])])
    total = np.add.reduceat(n, new)
    m = _mix(d[new].astype(np.int64).view(np.uint64) * np.uint64(BASE) + pos[new].astype(np.uint64))
    none = np.zeros(len(new), np.int64)
    return _stretch_batch(m, none, none, d[new], c[new], pos[new], -total)


def shard_repeats(shard: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """The repeats among a shard's stretches (m, doc, copy, pos, bytes), by suffix array."""
    doc, copy, pos = (shard.column(i).to_numpy() for i in (1, 2, 3))
    parts = shard.column(4).to_pylist()
    t = np.frombuffer(b"\0".join(parts), np.uint8)
    length = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(length + 1) - length - 1
    sa = suffix_array(t)
    shared = permuted_common_prefixes(t, sa, size)[sa]
    # windows: places with `size` bytes left in their stretch
    owner = np.searchsorted(starts, sa, "right") - 1
    window = sa + size <= starts[owner] + length[owner]
    group = np.cumsum(shared < size)  # suffixes of one group share their first `size` symbols
    owner, at, group = owner[window], sa[window], group[window]
    d, c, p = doc[owner], copy[owner], pos[owner] + at - starts[owner]
    order = np.lexsort((p, c, d, group))
    again = np.r_[False, group[order][1:] == group[order][:-1]]
    out = order[again]
    if len(out):
        r = _gone(d[out], c[out], p[out], np.ones(len(out), np.int64))
        yield pa.RecordBatch.from_arrays([r.column(3), r.column(4), r.column(5), pa.compute.negate(r.column(6))], names=["doc", "copy", "pos", "n"])


def covered(n_bytes: int, ranges: list[dict], size: int) -> list[tuple[int, int]]:
    """The runs of bytes that the windows of the ranges cover, in order, merged."""
    out: list[list[int]] = []
    for a, b in sorted((r["pos"], r["pos"] + r["n"] - 1 + size) for r in ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, min(b, n_bytes)])
    return [tuple(r) for r in out]


def without_repeats(docs: DataFrame, size: int = 100, **options) -> DataFrame:
    """doc_id, kept (binary), n_bytes, spans (array of start, end of the removed runs)."""
    ranges, packed = repeats(docs, size, **options)
    per_doc = ranges.groupBy("doc", "copy").agg(F.collect_list(F.struct("pos", "n")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = zstandard.ZstdDecompressor()
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            ids, kept, n, spans = [], [], [], []
            for d, c, z, r in zip(*(batch.column(i).to_pylist() for i in range(4))):
                text = decoder.decompress(z)
                runs = covered(len(text), r or [], size)
                at, parts = 0, []
                for a, b in runs:
                    parts.append(text[at:a])
                    at = b
                ids.append(None if d == NO_ID and c < 0 else d)
                kept.append(b"".join([*parts, text[at:]]))
                n.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kept, pa.binary()), pa.array(n, pa.int64()), pa.array(spans, spans_type), batch.column(4)], names=["doc_id", "kept", "n_bytes", "spans", "times"])

    joined = packed.join(per_doc, ["doc", "copy"], "left").select("doc", "copy", "z", "ranges", "times")
    out = joined.mapInArrow(run, "doc_id bigint, kept binary, n_bytes bigint, spans array<struct<start:int,end:int>>, times int")
    return out.withColumn("row", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "row")


def dedup_digest(docs: DataFrame) -> DataFrame:
    out = without_repeats(docs)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
