"""SimHash near-duplicate groups over pigeonhole blocks.

Fingerprints are grouped before anything is compared, so exact copies cost one row. The 64
bits are cut into `blocks` pieces; two fingerprints within `distance` bits agree on at least
blocks - distance of them, so every choice of that many pieces is a join key. Pairs that meet
under a key are verified by their Hamming distance.

A key shared by more than `pair_limit` fingerprints (a huge group of near copies) does not
form pairs: there each fingerprint is posted under itself and, per bit outside the shared
pieces, under the value with that bit flipped. For distance 2 two fingerprints meet under a
posted value exactly if they differ in two bits or fewer, so linking all of them to the least
one keeps every link's effect with a number of rows linear in the group.

Null text counts as no words (fingerprint zero); no documents give no rows; repeated rows and
repeated ids stay and share a component; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, utf8

BITS = 64


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of one text: a bit is set if it is set in over half of the shingles' XXH64."""
    words = text.lower().split()  # bytes: A-Z only, split at the six white-space bytes
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    stops = (ends - 1)[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops)), np.uint64, len(starts))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):  # bounded memory for very long texts
        part = h[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def wide_fingerprint(hashes: np.ndarray, words: int) -> np.ndarray:
    """A SimHash of 64 * words bits of different features' 64-bit hashes, as bigints: the hashes are
    mixed anew for every word."""
    rng = np.random.default_rng(7)
    by = rng.integers(0, 1 << 63, words, np.uint64) * np.uint64(2) + np.uint64(1)
    counts = np.zeros(BITS * words, np.int64)
    for at in range(0, len(hashes), 1 << 10):  # bounded memory for very long texts
        x = hashes[at : at + (1 << 10), None] * by
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        counts += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (bigint holding the 64 bits) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def _masks(distance: int, blocks: int) -> list[int]:
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    pieces = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(pieces, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, distance: int = 2, blocks: int = 4, pair_limit: int = 32) -> DataFrame:
    """Edges a, b between distinct fingerprints (column fp) whose components are those of the
    relation `differs in distance bits or fewer`."""
    if distance != 2:
        raise ValueError("the posting of large groups is exact for distance 2")
    masks = _masks(distance, blocks)
    keyed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])).alias("s")).select("fp", "s.k", "s.key")
    sizes = keyed.groupBy("k", "key").agg(F.count("*").alias("n")).where("n > 1")
    keyed = cut(keyed.join(sizes, ["k", "key"]), "blocks")
    few = keyed.where(F.col("n") <= pair_limit)
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= distance
    pairs = few.alias("x").join(few.alias("y"), (F.col("x.k") == F.col("y.k")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp")) & near).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    flips = F.element_at(F.array(*[F.array(F.lit(0).cast("bigint"), *[F.lit(_signed(1 << b)) for b in range(BITS) if not m >> b & 1]) for m in masks]), F.col("k") + 1)
    posted = keyed.where(F.col("n") > pair_limit).select("fp", "k", F.explode(flips).alias("flip")).select("fp", "k", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
    star = posted.groupBy("k", "at").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a < top")
    stars = posted.join(star.select("k", "at", "a"), ["k", "at"]).where("a <> fp").select("a", F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, distance: int = 2, blocks: int = 4, shingle: int = 3) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links) for every row."""
    marked = cut(fingerprints(docs, shingle), "fp")
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("fp"), distance, blocks))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    table = rooted.join(ids, "root").select("fp", "component_id")
    return marked.join(table, "fp", "left").select("doc_id", "fp", "component_id")


def hex64(column):
    """A bigint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
