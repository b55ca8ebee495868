"""Mixing sources to target weights by blocks of words.

The words of a source, its documents in a fixed order, form one stream that is packed into
blocks of `block` words; only a source's last block may be shorter. Targets follow the weights
and stop at `cap` times a source's size (the excess goes to the others by weight). Slot j of a
source reads block permute(epoch, j mod n) of its n blocks, where a keyed permutation of the
indices stands for each epoch (j div n), so all blocks are read before one repeats. A source has
as many slots as its target needs, the last of which reads only the words that are still
wanting: the mixture takes the target, rounded to a word, of sources of any size.

Every output shard draws multinomial counts of the sources for its slots, one pseudorandom draw
a slot; a balancing shard takes what the draws leave over. Slots meet blocks by index in a join.

Random draws depend on the seed and the slot only: reruns agree. Null text has no words; a null
source is a source of its own, last in order; documents without words get nothing; repeated
rows count as documents of their own; no documents give no rows. Extra columns are ignored by
the digest; mixed_documents() keeps them, but for those named like a column it adds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..prefix import Running, prefix_scans
from .common import WORD, cut, running_sums, sets_aside

#: Weights of the sources in order, repeating (fixed by the contract).
WEIGHTS = (5, 2, 1)


@dataclass
class Mix:
    """targets: src, source_size, weight, target, n_blocks, n_slots, part (words of the last slot,
    0 if it is whole). docs: doc_id, src, size, h (a hash of the text), start (of its words in the
    source's stream). slots: shard, src, slot, block, words (it reads at most). taken: doc_id, src,
    size, h, start, taken. src is the source led by =, or empty for null."""

    targets: DataFrame
    docs: DataFrame
    slots: DataFrame
    taken: DataFrame


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = 3.0) -> DataFrame:
    """src, source_size, weight and target from a table of src, source_size (one row a source).

    Targets are min(cap * size, level * weight) with the level at which they add up to the
    total: the fixed point of resharing the excess by weight. With the first k sources (by
    size a weight) at their caps the rest would need the level (total - caps) / weights; that
    is greatest for the right k."""
    ranked = running_sums(sizes, [F.col("src") == "", F.col("src")], {"rank": F.lit(1)})
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    t = cut(ranked.select("src", "source_size", w.alias("weight"), (F.col("source_size") * F.lit(float(cap))).alias("most")), "weights")
    total, heavy = t.agg(F.sum("source_size").cast("double"), F.sum("weight")).first()
    by_ratio = running_sums(t, [F.col("most") / F.col("weight"), F.col("src")], {"capped": F.col("most"), "before": F.col("weight")})
    level = by_ratio.agg(F.max((F.lit(total) - F.col("capped")) / (F.lit(heavy) - F.col("before")))).first()[0]
    return t.select("src", "source_size", "weight", F.least("most", F.lit(level) * F.col("weight")).alias("target"))


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """A keyed pseudorandom permutation of 0..n-1 (element by element), or its inverse: four
    Feistel rounds on the least even number of bits that holds n, walked until the value falls
    below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    n, key = n.astype(np.uint64), key.astype(np.uint64)

    def scramble(side: np.ndarray, k: np.ndarray, r: int) -> np.ndarray:
        mixed = (side + k + np.uint64(r * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x94D049BB133111EB)
        return mixed ^ (mixed >> np.uint64(32))

    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            if back:
                left, right = right ^ (scramble(left, k, 3 - r) & m), left
            else:
                left, right = right, left ^ (scramble(right, k, r) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _epoch_key(seed: int, src: str, epoch: np.ndarray) -> np.ndarray:
    return np.full(len(epoch), _key(seed, src), np.uint64) + epoch.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def slots_for(src: str, size: int, words: int, block: int, seed: int) -> tuple[int, int, int]:
    """Blocks of a source, slots that take `words` words of it in all, and the words of the last
    slot (0 if it is a whole block)."""
    n = -(-size // block)
    if not size or words <= 0:
        return n, 0, 0
    tail = size - (n - 1) * block
    epoch, rest = divmod(words, size)
    # where in the last epoch the source's last block comes, which may be short
    at = int(permute(np.array([n - 1]), np.array([n]), _epoch_key(seed, src, np.array([epoch])), back=True)[0])
    if rest < at * block + tail:
        j, part = divmod(rest, block)
    else:
        j = (rest + block - tail) // block
        part = rest - (j * block - (block - tail))
    return n, epoch * n + j + (part > 0), part


def mix_sources(docs: DataFrame, block: int = 64, shard_slots: int = 4096, weights: tuple[int, ...] = WEIGHTS, cap: float = 3.0, seed: int = 42) -> Mix:
    """docs: doc_id, text, source."""
    sized = cut(docs.select("doc_id", _src().alias("src"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), F.xxhash64("text").alias("h")), "sizes")
    targets = source_targets(cut(sized.groupBy("src").agg(F.sum("size").alias("source_size")), "sources"), weights, cap)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [min(round(t), int(cap * n)) for n, t in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())]
            got = [slots_for(s, n, w, block, seed) for s, n, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), words)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([g[i] for g in got], pa.int64()) for i in range(3))], names=["src", "source_size", "weight", "target", "n_blocks", "n_slots", "part"])

    targets = cut(targets.mapInArrow(plan, "src string, source_size bigint, weight double, target double, n_blocks bigint, n_slots bigint, part bigint"), "targets")

    # the place of each document in its source's stream: sums within buckets, then over buckets
    rows = sized.count()
    buckets = max(64, min(rows // 1000, 65_536))
    placed = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "h"), F.lit(buckets)))
    within = placed.withColumn("before", F.sum("size").over(W.partitionBy("src", "bucket").orderBy("doc_id", "size", "h").rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
    per_bucket = placed.groupBy("src", "bucket").agg(F.sum("size").alias("total"))
    per_bucket = per_bucket.withColumn("base", F.sum("total").over(W.partitionBy("src").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("total"))
    stream = cut(within.join(per_bucket.select("src", "bucket", "base"), ["src", "bucket"]).select("doc_id", "src", "size", "h", (F.col("base") + F.col("before")).alias("start")), "stream")

    slots = cut(_slots(targets, block, shard_slots, seed), "slots")

    # the takes of every block, joined by index with the documents' shares of the blocks
    takes = slots.groupBy("src", "block", "words").agg(F.count("*").alias("times"))
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    # a share lies in one block, or spans the blocks that a document fills from end to end
    shares = stream.where("size > 0").select("src", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    share = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words")) - F.greatest(F.col("start"), F.col("block") * block)
    got = shares.join(takes, ["src", "block"]).groupBy("src", "start").agg(F.sum(F.greatest(share, F.lit(0)) * F.col("times")).alias("taken"))
    # (src, start) names a document that has words
    words = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    taken = stream.join(got, ["src", "start"], "left").select("doc_id", "src", "size", "h", "start", words.alias("taken"))
    return Mix(targets, stream, slots, taken)


def _src():
    return F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))


def _slots(targets: DataFrame, block: int, shard_slots: int, seed: int) -> DataFrame:
    """shard, src, slot, block, words: every slot of the mixture and the block it reads.

    The sources' slots, laid end to end, are one row of numbers, and a draw is a number of it: a
    shard's draws are multinomial with chances by slots. Stretches of the row meet draws by
    buckets of `width` numbers, so that no source, however large, is one task's."""
    spark = targets.sparkSession
    total = targets.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    n_shards = max(1, -(-total // shard_slots))
    parts = max(spark.sparkContext.defaultParallelism, total // 500_000)
    width = 64
    wide = targets.where("n_slots > 0").select("src", "n_slots", "n_blocks", "part")
    laid = running_sums(wide, [F.col("src")], {"lo": F.col("n_slots")}).select("src", "lo", (F.col("lo") + F.col("n_slots")).alias("hi"))
    laid = laid.select("src", "lo", "hi", F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}"))).alias("bucket"))
    draws = spark.range(0, total, 1, int(parts)).select(F.expr(f"id div {shard_slots}").alias("shard"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(total, 1))).alias("u"))
    draws = draws.withColumn("bucket", F.expr(f"u div {width}"))
    met = draws.join(laid, (draws["bucket"] == laid["bucket"]) & (F.col("lo") <= F.col("u")) & (F.col("u") < F.col("hi")))
    drawn = cut(met.groupBy("src", "shard").agg(F.count("*").alias("n")), "drawn")
    # a running sum over shards says which of a source's slots a shard has
    drawn = prefix_scans(drawn, ["src"], ["shard"], F.expr("shard div 1024"), {"stop": Running(F.col("n"), "sum")}).withColumn("from", F.col("stop") - F.col("n"))
    drawn = cut(drawn, "runs")
    most = wide.select("src", "n_slots")
    kept = drawn.join(most, "src").where("from < n_slots").select("shard", "src", "from", F.least("stop", "n_slots").alias("stop"))
    # what the draws left of a source goes to the balancing shard
    left = most.join(drawn.groupBy("src").agg(F.max("stop").alias("drawn")), "src", "left").select(F.lit(n_shards).cast("bigint").alias("shard"), "src", F.least(F.coalesce("drawn", F.lit(0)), "n_slots").alias("from"), F.col("n_slots").alias("stop")).where("from < stop")
    runs = kept.unionByName(left).join(wide, "src")
    step = 8192  # long runs are cut, so that one source's share of a shard is no large row
    runs = runs.withColumn("from", F.explode(F.sequence("from", F.col("stop") - 1, F.lit(step)))).withColumn("stop", F.least("stop", F.col("from") + step))
    runs = runs.repartition(int(parts), "shard", "src", "from")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, src, a, b, n, n_slots, part in zip(*(batch.column(i).to_pylist() for i in range(7))):
                slot = np.arange(a, b)
                at = permute(slot % n, np.full(len(slot), n), _epoch_key(seed, src, slot // n))
                words = np.full(len(slot), block)
                if part and b == n_slots:
                    words[-1] = part
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), shard)), pa.repeat(src, len(slot)), pa.array(slot), pa.array(at), pa.array(words)], names=["shard", "src", "slot", "block", "words"])

    return runs.select("shard", "src", "from", "stop", "n_blocks", "n_slots", "part").mapInArrow(number, "shard bigint, src string, slot bigint, block bigint, words bigint")


def _key(seed: int, src: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(src.encode(), seed)


def mix_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target (its source's), taken for every row."""
    mix = mix_sources(docs, **options)
    # one row a source: a few bytes each, in one broadcast while their number is small, by join beyond it
    return mix.taken.join(mix.targets.select("src", "source_size", "target"), "src").select("doc_id", "size", "source_size", "target", "taken")


@sets_aside("doc_id", "text", "source", "size", "target", "taken")
def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mixture takes words of: the columns of docs, then size, target (its
    source's) and taken. Rows alike in doc_id, source and text share their takes in any order."""
    mix = mix_sources(docs.select("doc_id", "text", "source"), **options)
    key = ["_doc", "_src", "_h"]
    alike = W.partitionBy(*key)
    taken = mix.taken.join(mix.targets.select("src", "target"), "src").select(F.col("doc_id").alias("_doc"), F.col("src").alias("_src"), F.col("h").alias("_h"), "start", "size", "target", "taken")
    taken = taken.withColumn("_nth", F.row_number().over(alike.orderBy("start"))).where("taken > 0").drop("start")
    rows = docs.drop("size", "target", "taken").withColumns({"_doc": F.col("doc_id"), "_src": _src(), "_h": F.xxhash64("text")})
    rows = rows.withColumn("_nth", F.row_number().over(alike.orderBy("_h")))
    same = [rows[c].eqNullSafe(taken[c]) for c in (*key, "_nth")]
    return rows.join(taken, same).select(*[rows[c] for c in docs.columns if c not in ("size", "target", "taken")], "size", "target", "taken")
