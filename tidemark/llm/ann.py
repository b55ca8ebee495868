"""Approximate nearest neighbours by cosine: NN-descent builds a neighbour graph, queries walk it.

Equal vectors are one node; a node keeps the ids of its `keep` least members, all a search for
fewer neighbours can return. The graph starts from random-hyperplane leaves (pairs inside a
leaf; leaves of bounded size) and improves by NN-descent: every node introduces its neighbours
and reverse neighbours to each other, and pairs that beat one side's worst neighbour enter its
list. Guiding similarities use unit vectors in single precision; all that a search holds when it
ends is ranked by cosines of the original vectors in double precision. A node that very many
others list introduces them in groups of about six times the list length.

A query starts at its own node if it is indexed, and at the entry nodes otherwise, and keeps
opening the nearest unopened nodes of its beam until the beam has none.

Vectors that are null, zero, or hold null, NaN or infinite components take no part, nor do rows
without an id; vectors of another length than most are told apart by length and never
compared; repeated rows of one id and vector count once; fewer candidates than asked for give
all; ties go to the smaller vec_id; no vectors give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut, drop_cut

GRAPH = "id bigint, nbrs array<bigint>, sims array<float>, fresh array<boolean>"


def valid(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v (array<double>) of the rows that take part."""
    v = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine & F.exists("v", lambda x: x != 0))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, v -> id, b: the unit vector in single precision."""
    for batch in batches:
        out = []
        for v in batch.column(1).to_pylist():
            x = np.array(v)
            x /= np.abs(x).max()
            out.append((x / np.sqrt((x * x).sum())).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "b"])


def _matrix(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), np.float32).reshape(len(cells), -1)


def _whole_groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by a key column, cut anew so that no key spans two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        first = int(np.searchsorted(k, k[-1], "left"))
        if held and held[-1].column(key)[-1].as_py() != k[0]:
            yield pa.concat_batches(held)
            held = []
        if first:
            yield pa.concat_batches([*held, batch.slice(0, first)])
            held = []
        held.append(batch.slice(first))
    if held:
        yield pa.concat_batches(held)


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1 if len(keys) else 0))
    yield from zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)])


def _by_node(edges: DataFrame, run: Callable, schema: str, key: str = "id") -> DataFrame:
    return edges.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def nodes(vectors: DataFrame, keep: int) -> DataFrame:
    """id (the least vec_id), v, members (the keep least vec_ids) a different vector."""
    rows = valid(vectors).withColumn("at", F.xxhash64("v"))
    least = W.partitionBy("at", "v").orderBy("vec_id")
    distinct = rows.groupBy("at", "v", "vec_id").agg(F.lit(1).alias("one"))
    few = distinct.withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= keep)  # limited before the shuffle as well
    return few.groupBy("at", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("members")).select(F.element_at("members", 1).alias("id"), "v", "members")


def _leaves(packed: DataFrame, n: int, trees: int, leaf: int, seed: int) -> DataFrame:
    """tree, leaf, id, b: leaves of random hyperplanes; a crowded one is dealt into parts of
    about `leaf` by a hash."""
    bits = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[int, list[int]] = {}
            cells = batch.column(1).to_pylist()
            for i, c in enumerate(cells):
                groups.setdefault(len(c), []).append(i)
            for size, rows in groups.items():
                x = _matrix([cells[i] for i in rows])
                planes = np.random.default_rng([seed, size]).standard_normal((x.shape[1], trees * bits)).astype(np.float32)
                signs = (x @ planes > 0).reshape(len(rows), trees, bits)
                codes = (signs * (1 << np.arange(bits))).sum(2) + (size << 40)
                ids = batch.column(0).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([ids, pa.array([cells[i] for i in rows], pa.binary()), pa.array(codes.tolist(), pa.list_(pa.int64()))], names=["id", "b", "codes"])

    coded = packed.mapInArrow(code, "id bigint, b binary, codes array<bigint>").select("id", "b", F.posexplode("codes").alias("tree", "leaf"))
    sizes = coded.groupBy("tree", "leaf").agg(F.count("*").alias("n"))
    parts = coded.join(sizes, ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("id", "tree"), F.ceil(F.col("n") / (2 * leaf))))
    return parts.select(F.xxhash64("tree", "leaf", "part").alias("leaf"), "id", "b")


def build_graph(nodes_: DataFrame, k: int = 20, trees: int = 10, leaf: int = 120, rounds: int = 4, least_change: float = 0.01, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(graph, packed): id, nbrs, sims, fresh with up to k neighbours, nearest first; id, b."""
    packed = cut(nodes_.select("id", "v").mapInArrow(_units, "id bigint, b binary"), "packed")
    n = packed.count()

    def pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches):
            ids, cells = batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for a, b in _runs(batch.column(0).to_numpy()):
                x = _matrix(cells[a:b])
                m = b - a
                top = min(k, m - 1)
                if top < 1:
                    continue
                sims = x @ x.T
                np.fill_diagonal(sims, -2)
                best = np.argpartition(-sims, top - 1, 1)[:, :top]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[a:b], top)), pa.array(ids[a:b][best].ravel()), pa.array(np.take_along_axis(sims, best, 1).ravel())], names=["id", "nbr", "sim"]
                )

    edges = _by_node(_leaves(packed, n, trees, leaf, seed), pair_up, "id bigint, nbr bigint, sim float", "leaf").withColumn("fresh", F.lit(True))
    graph = cut(_by_node(edges, _best_of(k), GRAPH), "graph")
    for _ in range(rounds):
        found = _introduce(graph, packed, k)
        old = graph.select("id", F.explode(F.arrays_zip("nbrs", "sims")).alias("e")).select("id", F.col("e.nbrs").alias("nbr"), F.col("e.sims").alias("sim"), F.lit(False).alias("fresh"))
        new = cut(_by_node(old.unionByName(found), _best_of(k), GRAPH), "graph")
        drop_cut(graph)
        graph = new
        changed = graph.agg(F.coalesce(F.sum(F.size(F.filter("fresh", lambda x: x))), F.lit(0))).first()[0]
        if changed < least_change * k * n:
            break
    return graph, packed


def _best_of(k: int) -> Callable:
    """The k nearest different neighbours of each node, old before new of the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches):
            ids, nbr, sim, fresh = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            order = np.lexsort((fresh, nbr, ids))
            ids, nbr, sim, fresh = ids[order], nbr[order], sim[order], fresh[order]
            first = np.r_[True, (ids[1:] != ids[:-1]) | (nbr[1:] != nbr[:-1])]
            ids, nbr, sim, fresh = ids[first], nbr[first], sim[first], fresh[first]
            order = np.lexsort((nbr, -sim, ids))
            ids, nbr, sim, fresh = ids[order], nbr[order], sim[order], fresh[order]
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.r_[starts, len(ids)]))
            keep = place < k
            ids, nbr, sim, fresh = ids[keep], nbr[keep], sim[keep], fresh[keep]
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            offsets = pa.array(np.r_[starts, len(ids)].astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in (nbr, sim.astype(np.float32), fresh.astype(bool))]
            yield pa.RecordBatch.from_arrays([pa.array(ids[starts]), *lists], names=["id", "nbrs", "sims", "fresh"])

    return run


def _introduce(graph: DataFrame, packed: DataFrame, k: int) -> DataFrame:
    """One round: id, nbr, sim, fresh of pairs that meet at a common neighbour and beat the
    worst neighbour of id."""
    flat = graph.select("id", F.explode(F.arrays_zip("nbrs", "sims", "fresh")).alias("e")).select("id", F.col("e.nbrs").alias("nbr"), F.col("e.sims").alias("sim"), F.col("e.fresh").alias("fresh"))
    meet = flat.select(F.col("id").alias("at"), F.col("nbr").alias("id"), "sim", "fresh").union(flat.select(F.col("nbr").alias("at"), "id", "sim", "fresh"))
    worst = graph.select("id", F.when(F.size("sims") >= k, F.element_at("sims", -1)).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    # only where somebody is new there is anything to introduce; vectors go nowhere else
    crowd = meet.groupBy("at").agg(F.count("*").alias("n"), F.max("fresh").alias("news")).where("news").select("at", F.ceil(F.col("n") / (6 * k)).alias("parts"))
    crowd = cut(crowd, "crowd")  # a table of its own, so that a hub's rows are split in the join
    meet = meet.join(crowd, "at").select(F.xxhash64("at", F.pmod(F.xxhash64("id", "at"), "parts")).alias("at"), "id", "sim", "fresh")
    guests = meet.join(packed.join(worst, "id"), "id").select("at", "id", "fresh", "worst", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches):
            at, ids, fresh, worst = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            cells = batch.column(4).to_pylist()
            out = []
            for a, b in _runs(at):
                _, one = np.unique(ids[a:b], return_index=True)
                rows = a + one
                if len(rows) < 2 or not fresh[rows].any():
                    continue
                for size in {len(cells[i]) for i in rows}:
                    own = rows[[len(cells[i]) == size for i in rows]]
                    x = _matrix([cells[i] for i in own])
                    s = x @ x.T
                    better = (s > worst[own][:, None]) & (fresh[own][:, None] | fresh[own][None, :])
                    np.fill_diagonal(better, False)
                    i, j = np.nonzero(better)
                    out.append((ids[own[i]], ids[own[j]], s[i, j]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[c] for o in out])) for c in range(3)], names=["id", "nbr", "sim"])

    found = _by_node(guests, run, "id bigint, nbr bigint, sim float", "at")
    return found.withColumn("fresh", F.lit(True))


BEAM = "query bigint, q binary, beam array<struct<id:bigint,sim:float,open:boolean>>, going boolean"


def search(queries: DataFrame, graph: DataFrame, packed: DataFrame, ef: int = 256, width: int = 64, entries: int = 32) -> DataFrame:
    """query, id: the nodes in each query's beam when its walk ended.

    queries: query, q (unit vector), node (its own node if indexed, else null). A step opens the
    `width` nearest unopened nodes of the beam, reads their lists and keeps the `ef` nearest; a
    node that has left the beam never comes back, so the walk ends by itself."""
    starts = [r.id for r in packed.select("id").orderBy(F.xxhash64("id"), "id").limit(entries).collect()]
    own = queries.where("node is not null").select("query", "q", F.col("node").alias("id"))
    lost = queries.where("node is null").select("query", "q", F.explode(F.array(*[F.lit(i).cast("bigint") for i in starts]).cast("array<bigint>")).alias("id"))
    arrow = pa.schema([("query", pa.int64()), ("q", pa.binary()), ("beam", pa.list_(pa.struct([("id", pa.int64()), ("sim", pa.float32()), ("open", pa.bool_())]))), ("going", pa.bool_())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a query: its beam so far (or none) and newly met nodes."""
        for batch in _whole_groups(batches):
            query = batch.column(0).to_numpy()
            q, beams, ids, cells = (batch.column(i).to_pylist() for i in range(1, 5))
            out = []
            for a, b in _runs(query):
                held = {x["id"]: (x["sim"], x["open"]) for beam in beams[a:b] for x in beam or ()}
                fresh = {i: c for i, c in zip(ids[a:b], cells[a:b]) if i is not None and c is not None and i not in held and len(c) == len(q[a])}
                if fresh:
                    s = _matrix(list(fresh.values())) @ _matrix([q[a]])[0]
                    held.update({i: (float(x), True) for i, x in zip(fresh, s)})
                best = sorted(held.items(), key=lambda x: (-x[1][0], x[0]))[:ef]
                out.append({"query": int(query[a]), "q": q[a], "beam": [{"id": i, "sim": s, "open": o} for i, (s, o) in best], "going": any(o for _, (_, o) in best)})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    nothing = F.lit(None).cast("array<struct<id:bigint,sim:float,open:boolean>>")
    first = own.union(lost).join(packed, "id").select("query", "q", nothing.alias("beam"), "id", "b")
    state = cut(_by_node(first, merge, BEAM, "query"), "beam")
    while state.where("going").limit(1).count():
        nearest = F.slice(F.filter("beam", lambda x: x["open"]), 1, width)
        frontier = state.where("going").select("query", "q", F.explode(nearest).alias("x")).select("query", "q", F.col("x.id").alias("id"))
        met = frontier.join(graph.select("id", "nbrs"), "id").select("query", "q", F.explode("nbrs").alias("id")).distinct()
        known = state.where("going").select("query", F.explode("beam").alias("x")).select("query", F.col("x.id").alias("id"))
        met = met.join(known, ["query", "id"], "left_anti").join(packed, "id").select("query", "q", nothing.alias("beam"), "id", "b")
        opened = F.transform(F.filter("beam", lambda x: x["open"]), lambda x: x["id"])
        closed = F.transform("beam", lambda x: F.struct(x["id"].alias("id"), x["sim"].alias("sim"), (x["open"] & ~F.array_contains(F.slice(opened, 1, width), x["id"])).alias("open")))
        rows = state.select("query", "q", F.when(F.col("going"), closed).otherwise(F.col("beam")).alias("beam"), F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("binary").alias("b"))
        new = cut(_by_node(rows.unionByName(met), merge, BEAM, "query"), "beam")
        drop_cut(state)
        state = new
    return state.select("query", F.explode("beam").alias("x")).select("query", F.col("x.id").alias("id"))


def _in_range(v: list[float]) -> np.ndarray:
    """v times a power of two, so that squares neither overflow nor vanish; cosines are the same
    to the last bit."""
    x = np.array(v, float)
    return np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, **options) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of queries (vec_id, embedding) its k nearest
    rows of vectors, a row with the query's own id left out."""
    known = cut(nodes(vectors, k + 1), "nodes")
    graph, packed = build_graph(known, **options)
    asked = valid(queries).distinct()
    asked = cut(asked.join(known.select(F.col("v"), F.col("id").alias("node")), "v", "left").select(F.col("vec_id").alias("query"), "v", "node"), "asked")
    q = asked.select(F.col("query").alias("id"), "v").mapInArrow(_units, "id bigint, b binary").withColumnsRenamed({"id": "query", "b": "q"})
    beams = search(q.join(asked.select("query", "node"), "query"), graph, packed)
    found = beams.join(known.withColumnRenamed("v", "w"), "id").join(asked.select("query", "v"), "query").select("query", "v", "w", "members")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for query, v, w, members in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if len(v) == len(w):
                    a, b = _in_range(v), _in_range(w)
                    s = float(np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b))))
                    out += [(query, m, s) for m in members if m != query]
            cols = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(cols[0]), pa.int64()), pa.array(list(cols[1]), pa.int64()), pa.array(list(cols[2]), pa.float64())], names=["query_id", "vec_id", "score"])

    scored = found.mapInArrow(score, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
