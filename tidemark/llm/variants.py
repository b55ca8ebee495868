"""Spelling variants: words that one edit turns into each other, and the form each stands for.

A word's letters are hashed to a few symbols. One edit of a word changes its reduced word by one
edit at most, so each reduced word's whole one-edit neighbourhood over the few symbols (itself,
all deletions, replacements and insertions) is generated and joined with the reduced words there
are; words under joined reduced words are compared as they are. A reduced word is known by a
polynomial hash, from which every neighbour's hash follows by two multiplications, whatever the
word's length; chance hits fall out in the comparison and nothing is lost by them.

Where two reduced words stand for more than `crowd` pairs of words, these words are reduced again
to more symbols and joined anew, so a crowded reduced word is no all-pairs join; the last alphabet
tells nearly all letters apart.

Null texts have no words; a null id counts as the empty string in the deletions; repeated rows and
ids count each time; equal counts go by code-point order; extra columns are not looked at; an empty
table gives no rows. Words of any length are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut

#: The letters of a word.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (6, 32, 512)
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
CELLS = 1 << 20  # hashes that are made at a time


def words(docs: DataFrame, least: int = 6, one_in: int = 199) -> DataFrame:
    """word, n: the words of all texts, each run's code point h % length taken out where one_in
    divides h, the crc32 of `<id>:<run>`. Words of fewer than `least` code points go."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(f"({LETTERS}{{{least},}})"), F.lit(1))).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    word = F.when(h % one_in == 0, F.overlay("run", F.lit(""), (h % F.length("run") + 1).cast("int"), F.lit(1))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.length("word") >= least)


def _codes(some: list[str], symbols: int) -> np.ndarray:
    """Symbols 1 to `symbols` of the code points of some words, one after the other."""
    points = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return points % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    p = np.full(n, BASE, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def reduced_hash(some: list[str], symbols: int) -> np.ndarray:
    """Hash of each word's reduced word: its symbols as the digits of a number to the base BASE."""
    lengths = np.fromiter(map(len, some), np.int64, len(some))
    if not lengths.sum():
        return np.zeros(len(some), np.uint64)
    ends = np.cumsum(lengths)
    place = np.repeat(ends, lengths) - np.arange(ends[-1]) - 1
    sums = np.append(np.uint64(0), np.cumsum(_codes(some, symbols) * _powers(int(lengths.max()))[place]))
    return sums[ends] - sums[ends - lengths]


def neighbour_hashes(some: list[str], symbols: int) -> np.ndarray:
    """A row for each of some words of one length: hashes of its reduced word and of all that one
    deletion, replacement or insertion over the symbols makes of it."""
    m, n = len(some), len(some[0])
    c = _codes(some, symbols).reshape(m, n)
    power = _powers(n + 2)
    digit = c * power[n - 1 :: -1][:n]
    before = np.concatenate([np.zeros((m, 1), np.uint64), np.cumsum(digit, 1)], 1)  # of the first i symbols
    after = before[:, -1:] - before  # of the symbols from i on
    base, back = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
    letters = np.arange(1, symbols + 1, dtype=np.uint64)
    deleted = before[:, :-1] * back + after[:, 1:]
    replaced = before[:, -1:, None] - digit[:, :, None] + letters * power[n - 1 :: -1][:n, None]
    inserted = (before * base + after)[:, :, None] + letters * power[n::-1][: n + 1, None]
    return np.concatenate([before[:, -1:], deleted, replaced.reshape(m, -1), inserted.reshape(m, -1)], 1)


def _neighbourhoods(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """a, b: every reduced word's hash with those of its neighbourhood, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_length: dict[int, list[str]] = {}
            for w in batch.column(0).to_pylist():
                by_length.setdefault(len(w), []).append(w)
            for n, some in by_length.items():
                step = max(1, CELLS // (2 * (n + 1) * symbols))
                for at in range(0, len(some), step):
                    near = np.sort(neighbour_hashes(some[at : at + step], symbols), 1)
                    first = np.ones(near.shape, bool)
                    first[:, 1:] = near[:, 1:] != near[:, :-1]
                    a = np.repeat(reduced_hash(some[at : at + step], symbols), first.sum(1))
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(near[first].view(np.int64))], names=["a", "b"])

    # one word stands for each reduced word; words apart but of one hash all make theirs
    one = vocabulary.groupBy("r", "shape").agg(F.min("word").alias("word")).select("word")
    return one.mapInArrow(run, "a bigint, b bigint")


def _reduced(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """vocabulary with the hash r and a second hash (shape) of each word's reduced word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column(0).to_pylist()
            codes = _codes(some, symbols).astype("<u2").tobytes()
            ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) * 2).tolist()
            shapes = [codes[a:b] for a, b in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(reduced_hash(some, symbols).view(np.int64)), pa.array(shapes, pa.binary())], names=["word", "n", "r", "shape"])

    return vocabulary.select("word", "n").mapInArrow(run, "word string, n bigint, r bigint, shape binary")


def one_edit(a: Column, b: Column) -> Column:
    """Whether two texts differ by exactly one inserted, deleted or replaced code point."""
    return (F.abs(F.length(a) - F.length(b)) <= 1) & (F.levenshtein(a, b, 1) == 1)


def near_words(vocabulary: DataFrame, alphabets: tuple[int, ...] = ALPHABETS, crowd: int = 4096) -> DataFrame:
    """word, near, near_n: all pairs one edit apart, either way round. vocabulary: word, n, a row a word."""
    left, found = vocabulary, []
    for symbols in alphabets:
        v = cut(_reduced(left, symbols), "reduced")
        sizes = v.groupBy("r").agg(F.count("*").alias("m"))
        met = _neighbourhoods(v, symbols).join(sizes.select(F.col("r").alias("b"), F.col("m").alias("mb")), "b")
        met = met.join(sizes.select(F.col("r").alias("a"), F.col("m").alias("ma")), "a").select("a", "b", (F.col("ma") * F.col("mb")).alias("pairs"))
        met = cut(met.distinct(), "met")
        last = symbols == alphabets[-1]
        few = met if last else met.where(F.col("pairs") <= crowd)
        x = v.select(F.col("r").alias("a"), F.col("word"), F.length("word").alias("lx"))
        y = v.select(F.col("r").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"), F.length("word").alias("ly"))
        pairs = few.join(x, "a").join(y, "b").where((F.abs(F.col("lx") - F.col("ly")) <= 1) & one_edit(F.col("word"), F.col("near")))
        found.append(cut(pairs.select("word", "near", "near_n"), "near"))
        if last:
            break
        many = met.where(F.col("pairs") > crowd).select(F.col("a").alias("r")).distinct()
        left = cut(v.join(many, "r", "left_semi").select("word", "n"), "crowded")
        if left.isEmpty():
            break
    return found[0] if len(found) == 1 else reduce(DataFrame.unionByName, found).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root for word, form: forms followed to the last, twice as far each round. Counts rise
    along forms, so there is a last one, after few steps."""
    at = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = cut(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        drop_cut(at)
        at = further.select("word", "root")
        if further.where("moved").isEmpty():
            return at


def variants(vocabulary: DataFrame, times: int = 5, alphabets: tuple[int, ...] = ALPHABETS, crowd: int = 4096) -> DataFrame:
    """word, form (the near word of largest n, if that is at least `times` the word's; ties to the
    smallest), root (the last of the forms from word), n, n_near, form_n. vocabulary: word, n."""
    near = near_words(vocabulary, alphabets, crowd)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    out = vocabulary.select("word", "n").join(best, "word", "left")
    stands = -F.col("best.minus") >= F.col("n") * times
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(stands, F.col("best.near")).alias("form"), F.when(stands, -F.col("best.minus")).alias("form_n"))
    out = cut(out, "forms")
    followed = roots(out.where("form is not null"))
    return out.join(followed, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, least: int = 6, least_n: int = 5, times: int = 5) -> DataFrame:
    """variants() of the texts' words that occur least_n times or more."""
    return variants(cut(words(docs, least).where(F.col("n") >= least_n), "words"), times)
