"""Token counts of documents in flat token files, by a separator scan.

A flat file is nothing but token ids of fixed width, documents ended by a separator id, with
no index; it is kept and read in blocks of fixed length. Each block is searched for separators
in one vectorised pass. A document may start in one block and end many blocks later: a prefix
scan over the blocks' summaries (tokens since the last separator, separators so far) stitches
the ends together. The scan runs in two steps, within runs of `span` blocks and over the runs,
so no file is scanned in one task.

Documents are written as they come: null and empty texts have no tokens, repeated ids and rows are
documents of their own, extra columns are ignored, no documents give no rows. Files may be empty; tokens after the last separator of a file are a document of their own; a
document may have no tokens; block rows that are null or empty add nothing; repeated block
rows are not allowed (they would be two places of one file).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.files import opened
from .common import cut

#: The word pattern of the public byte-level vocabulary, as its publisher states it.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SEPARATOR = 50256  # free in that vocabulary


def write_token_blocks(docs: DataFrame, vocabulary: str = VOCABULARY, separator: int = SEPARATOR, block: int = 65536) -> DataFrame:
    """Tokenise documents into flat files, one a partition: file, block_no, ids (little-endian
    16-bit), and, beside the files, the documents in the order they were written: ids is null
    there and doc_ids holds them."""
    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    if max(ranks.values()) > 65535 or separator > 65535:
        raise ValueError("ids of over 16 bits")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = "file int, block_no bigint, ids binary, doc_ids array<bigint>"
    arrow = pa.schema([("file", pa.int32()), ("block_no", pa.int64()), ("ids", pa.binary()), ("doc_ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        from pyspark import TaskContext

        coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        file, at, order = TaskContext.get().partitionId(), 0, 0
        rest = np.zeros(0, "<u2")
        row = lambda no, ids, doc_ids: pa.RecordBatch.from_pylist([{"file": file, "block_no": no, "ids": ids, "doc_ids": doc_ids}], schema=arrow)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a in range(0, len(ids), 512):
                parts = [rest]
                for t in batch.column(1).slice(a, 512).to_pylist():
                    parts += [np.array(coder.encode_ordinary(t or ""), "<u2"), np.array([separator], "<u2")]
                rest = np.concatenate(parts)
                whole = len(rest) // block
                for i in range(whole):
                    yield row(at, rest[i * block : (i + 1) * block].tobytes(), None)
                    at += 1
                rest = rest[whole * block :]
                yield row(order, None, ids[a : a + 512])
                order += 1
        if len(rest):
            yield row(at, rest.tobytes(), None)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def read_token_files(spark: SparkSession, path: str, block: int = 65536, width: int = 2, blocks_a_task: int = 256) -> DataFrame:
    """Blocks of existing flat files of any size: file (its path), block_no, ids. Files are listed
    by Spark, cut into ranges of blocks, and the ranges dealt to tasks, which read no more of a
    file than theirs."""
    size = block * width
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("path").alias("file"), "length")  # the content is not read
    last = F.floor((F.col("length") - 1) / size)
    ranges = files.select("file", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(blocks_a_task).cast("bigint"))).alias("first"))
    tasks = max(spark.sparkContext.defaultParallelism, ranges.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opened(file, anywhere=True) as stream:
                    stream.seek(first * size)
                    for no in range(first, first + blocks_a_task):
                        if not (raw := stream.read(size)):
                            break
                        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([no], pa.int64()), pa.array([bytes(raw)], pa.binary())], names=["file", "block_no", "ids"])

    return ranges.repartition(min(tasks, 100_000), "file", "first").mapInArrow(read, "file string, block_no bigint, ids binary")


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR, width: int = 2, span: int = 1024) -> DataFrame:
    """file, ordinal (of the document in its file, from 0), n_tokens."""
    kind = dict(blocks.dtypes)["file"]
    blocks = blocks.select("file", "block_no", "ids").where("ids is not null")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ends: lengths of the documents that end here (the first counts from the block's start)
        for batch in batches:
            ends, tails = [], []
            for raw in batch.column(2).to_pylist():
                ids = np.frombuffer(raw, f"<u{width}")
                at = np.flatnonzero(ids == separator)
                ends.append(np.diff(at, prepend=-1) - 1)
                tails.append(len(ids) - (at[-1] + 1 if len(at) else 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ends, pa.list_(pa.int64())), pa.array(tails, pa.int64())], names=["file", "block_no", "ends", "tail"])

    scanned = cut(blocks.mapInArrow(scan, f"file {kind}, block_no bigint, ends array<bigint>, tail bigint"), "scan")
    s = scanned.select("file", "block_no", F.size("ends").cast("bigint").alias("n"), "tail", F.floor(F.col("block_no") / span).cast("bigint").alias("run"))
    # open: tokens since the last separator, up to a block's end; a block with a separator starts anew
    run = W.partitionBy("file", "run").orderBy("block_no")
    s = s.withColumn("before", F.sum("n").over(run) - F.col("n")).withColumn("since", F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).over(run))
    part = W.partitionBy("file", "run", "since").orderBy("block_no")
    s = s.withColumn("open", F.sum("tail").over(part))
    s = s.withColumn("carry", F.lag("open", 1, 0).over(run)).withColumn("fresh", F.coalesce(F.lag("since").over(run), F.lit(0)) == 0)
    runs = s.groupBy("file", "run").agg(F.sum("n").alias("n"), F.max_by("open", "block_no").alias("open"))
    over = W.partitionBy("file").orderBy("run")
    runs = runs.withColumn("base", F.sum("n").over(over) - F.col("n")).withColumn("since", F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).over(over))
    runs = runs.withColumn("open", F.sum("open").over(W.partitionBy("file", "since").orderBy("run"))).withColumn("from_runs", F.lag("open", 1, 0).over(over))
    placed = s.join(runs.select("file", "run", "base", "from_runs"), ["file", "run"]).select(
        "file", "block_no", (F.col("base") + F.col("before")).alias("ordinal"), (F.col("carry") + F.when(F.col("fresh"), F.col("from_runs")).otherwise(0)).alias("carry")
    )
    docs = scanned.join(placed, ["file", "block_no"]).select("file", "ordinal", "carry", F.posexplode("ends").alias("i", "len"))
    ended = docs.select("file", (F.col("ordinal") + F.col("i")).alias("ordinal"), (F.col("len") + F.when(F.col("i") == 0, F.col("carry")).otherwise(0)).alias("n_tokens"))
    last = runs.groupBy("file").agg(F.sum("n").alias("ordinal"), F.max_by("open", "run").alias("n_tokens")).where("n_tokens > 0")
    return ended.unionByName(last)


def document_counts(docs: DataFrame, **options) -> DataFrame:
    """doc_id, file, ordinal, n_tokens for every document, counted from flat files written of
    them."""
    written = cut(write_token_blocks(docs, **options), "tokens")
    counted = count_tokens(written)
    order = W.partitionBy("file").orderBy("block_no").rowsBetween(W.unboundedPreceding, 0)
    names = written.where("ids is null").select("file", "block_no", "doc_ids").withColumn("base", F.sum(F.size("doc_ids")).over(order) - F.size("doc_ids"))
    names = names.select("file", (F.col("base")).alias("base"), F.posexplode("doc_ids").alias("i", "doc_id")).select("file", (F.col("base") + F.col("i")).alias("ordinal"), "doc_id")
    return names.join(counted, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
