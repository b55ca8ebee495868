"""Benchmark decontamination by pigeonhole edit matching.

An item of n characters may be met with k = floor(rate * n) edits. Cut into k + 2 pieces, at
least two pieces of it survive any k edits untouched, shifted against each other by k at most,
so an Aho-Corasick automaton over the pieces finds two of them at every place worth checking;
Myers' bit-parallel distance then verifies the whole item in the text around the hits, with
its ends free. Both sides are lower-cased and their white space is read as one space first.

A benchmark of up to `group_chars` characters is one automaton, broadcast: its size is counted
first. A larger one is dealt by a hash of the item into groups of about that size; documents and
groups then meet in tasks, each of which reads one group of items and then its share of the
documents. Items shorter than `least` characters (after folding) are matched as whole words: from
an edge of a word to an edge of a word, with the same rate of edits. Null or empty items match
nothing; null or empty texts hold nothing; repeated items are one, repeated rows of documents are
matched each for itself; of places that are equally near the one that ends first counts; empty
tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, sets_aside

DOC, ITEM = 1, 0


def fold(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """The item in k + 2 pieces of near-equal length (one for k = 0), with their offsets."""
    n = k + 2 if k else 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def between_words(item: str, text: str, first: int, last: int, k: int) -> tuple[int, int, int] | None:
    """The least edit distance up to k of the item to a stretch of the text that starts at first
    to last and has no letter or digit next to it; its start and end."""
    best = None
    for a in range(max(0, first), min(last, len(text)) + 1):
        if text[max(0, a - 1) : a].isalnum():
            continue
        part = text[a : a + len(item) + k]
        row = list(range(len(item) + 1))
        for j in range(len(part) + 1):
            if j:
                new, c = [j], part[j - 1]
                for i, x in enumerate(item):
                    new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
                row = new
            if row[-1] <= k and not text[a + j : a + j + 1].isalnum() and (best is None or row[-1] < best[0]):
                best = (row[-1], a, a + j)
    return best


def myers(pattern: str, text: str, k: int) -> tuple[int, int]:
    """The least edit distance of the pattern to any substring of the text, and where the
    first such substring ends; a distance over k is returned as k + 1, with end -1. One bit a
    pattern character in a Python integer."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, end = full, 0, m, k + 1, -1
    get = masks.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        x = eq | minus
        d = ((((eq & plus) + plus) ^ plus) | eq) & full
        hp = (minus | ~(d | plus)) & full
        hm = plus & d
        if hp & top:
            score += 1
        elif hm & top:
            score -= 1
        hp = (hp << 1) & full  # row zero stays zero: the match may start anywhere
        hm = (hm << 1) & full
        plus = (hm | ~(x | hp)) & full
        minus = hp & x
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Finds the items of one group in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float, least: int):
        self.items: list[tuple[int, str, int]] = []
        self.words = ahocorasick.Automaton()
        at: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = fold(text)
            if not text:
                continue
            k = int(rate * len(text))
            index = len(self.items)
            self.items.append((item_id, text, k))
            for offset, piece in pieces(text, k):
                at.setdefault(piece, []).append((index, offset))
        for piece, where in at.items():
            self.words.add_word(piece, (len(piece), where))
        self.least = least
        if at:
            self.words.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """item_id, start and end in the folded text (around the match), distance: the best
        place of every item that occurs."""
        if not self.items:
            return []
        text = fold(text)
        checked: dict[int, list[tuple[int, int]]] = {}
        best: dict[int, tuple[int, int, int]] = {}
        seen: dict[int, list[tuple[int, int]]] = {}  # an item's hits: place, offset of the piece
        for last, (size, where) in self.words.iter(text):
            hit = last + 1 - size
            for index, offset in where:
                item_id, item, k = self.items[index]
                if best.get(index, (k + 1,))[0] == 0:
                    continue
                if k:
                    hits = seen.setdefault(index, [])
                    pair = False
                    for h, o in reversed(hits):
                        if h < hit - 2 * len(item):
                            break  # hits come by their ends, so starts are in order but for a piece's length
                        if o != offset and abs(h - o - hit + offset) <= k:
                            pair = True
                            break
                    hits.append((hit, offset))
                    if len(hits) > 64 and hits[0][0] < hit - 2 * len(item):
                        seen[index] = [x for x in hits if x[0] >= hit - 2 * len(item)]
                    if not pair:
                        continue
                a, b = max(0, hit - offset - k), hit - offset + len(item) + k
                if any(x <= a and b <= y for x, y in checked.get(index, ())[-4:]):
                    continue  # that stretch has been verified: hits come in order, so it is one of the last
                if k == 0:
                    whole = hit + len(item)
                    if len(item) < self.least and (text[max(0, hit - 1) : hit].isalnum() or text[whole : whole + 1].isalnum()):
                        continue
                    best[index] = (0, hit, whole)
                    continue
                a, b = max(0, a - k), b + k
                checked.setdefault(index, []).append((a, b))
                if text[a + (hit - offset - a) : hit - offset + len(item)] == item and hit >= offset and len(item) >= self.least:
                    best[index] = (0, hit - offset, hit - offset + len(item))
                    continue
                distance, end = myers(item, text[a:b], k)
                if distance <= k and len(item) < self.least:
                    got = between_words(item, text, hit - offset - 2 * k, hit - offset + 2 * k, k)
                    if got and got[0] < best.get(index, (k + 1,))[0]:
                        best[index] = got
                    continue
                if distance <= k and distance < best.get(index, (k + 1,))[0]:
                    # where it starts: the same search backwards from its end
                    back = myers(item[::-1], text[max(0, a + end - len(item) - k) : a + end][::-1], k)
                    best[index] = (distance, a + end - back[1], a + end)
        return [(self.items[i][0], start, end, distance) for i, (distance, start, end) in best.items()]


def contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, start, end (of the match in the folded text), distance: a row for every
    document and item that occurs in it, at the item's best place. Options are those of matches()."""
    return matches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), items, **options)


def matches(docs: DataFrame, items: DataFrame, rate: float = 0.1, least: int = 40, group_chars: int = 4_000_000, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """contaminated() with a doc_id of any type."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id bigint, start int, end int, distance int"
    id_type = pa.int64() if schema.startswith("doc_id bigint") else pa.string()
    texts = docs.select("doc_id", "text").where("text is not null")
    wanted = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("item")).where(F.length(F.trim("item")) > 0).distinct()
    chars = wanted.agg(F.coalesce(F.sum(F.length("item")), F.lit(0))).first()[0]

    def found(matcher: Matcher, ids: list, texts: list) -> pa.RecordBatch:
        rows = [(d, *m) for d, t in zip(ids, texts) for m in matcher.find(t)]
        cols = list(zip(*rows)) or [[]] * 5
        kinds = [id_type, pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], names=["doc_id", "item_id", "start", "end", "distance"])

    if chars <= group_chars:
        known = docs.sparkSession.sparkContext.broadcast([(r.item_id, r.item) for r in wanted.orderBy("item_id", "item").collect()])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(known.value, rate, least)
            for batch in batches:
                yield found(matcher, batch.column(0).to_pylist(), batch.column(1).to_pylist())

        return texts.mapInArrow(run, schema)

    # part = group + groups * share: every share of the documents meets every group
    groups = -(-chars // group_chars)
    shares = max(1, docs.sparkSession.sparkContext.defaultParallelism, texts.count() // 20_000)
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(int(n - 1))))
    of = lambda group, share: (F.col(group) + F.lit(int(groups)) * F.col(share)).alias("part")
    dealt_items = wanted.select("*", F.pmod(F.xxhash64("item_id", "item"), F.lit(int(groups))).alias("g"), numbers(shares).alias("s")).select(of("g", "s"), F.lit(ITEM).alias("kind"), F.col("item_id").alias("id"), F.col("item").alias("text"))
    dealt_docs = texts.select("*", F.pmod(F.xxhash64("doc_id", "text"), F.lit(int(shares))).alias("s"), numbers(groups).alias("g")).select(of("g", "s"), F.lit(DOC).alias("kind"), F.col("doc_id").alias("id"), "text")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, group, matcher = None, [], None
        for batch in batches:
            ids, texts = [], []
            for p, kind, i, t in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if p != part:
                    if ids:
                        yield found(matcher, ids, texts)
                    part, group, matcher, ids, texts = p, [], None, [], []
                if kind == ITEM:
                    group.append((i, t))
                elif group:
                    matcher = matcher or Matcher(group, rate, least)
                    ids.append(i)
                    texts.append(t)
            if ids:
                yield found(matcher, ids, texts)

    both = dealt_items.unionByName(dealt_docs).repartition(int(groups * shares), "part").sortWithinPartitions("part", "kind")
    return both.mapInArrow(meet, schema)


@sets_aside("doc_id", "text")
def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no item, with their columns. Documents that share a doc_id, or have
    none, are told apart by their texts."""
    named = docs.withColumn("_doc", F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").cast("binary"), 256))
    bad = cut(matches(named.select(F.col("_doc").alias("doc_id"), "text"), items, **options).select(F.col("doc_id").alias("_doc")).distinct(), "contaminated")
    return named.join(bad, "_doc", "left_anti").select(*docs.columns)
