"""The registered queries and the pipeline over a small directory of tables, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from tidemark.llm import decontam, secrets

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 7))) for _ in range(400)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(words, rng.integers(5, 80)))
        text += [" idiot moron", " password = abcdefghijkl0", "", f" {ITEM}", "\nline two.\n"][i % 5]
        rows.append((i, text, "en", [None, "a", "b"][i % 3], len(text)))
    rows += [(100 + i, rows[2][1], "en", "a", rows[2][4]) for i in range(4)] + [(200, None, None, None, None), (201, "", "en", "b", 0), (202, "x" * 5000, "en", "b", 5000)]
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 2), int(i % 5 == 0)) for i in range(60)], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, rng.standard_normal(6).tolist()) for i in range(120)], "vec_id bigint, embedding array<double>").write.parquet(f"{d}/embeddings.parquet")
    return d, [(i, t or "", s) for i, t, _, s, _ in rows]


def run(spark, tables, name):
    return entry.queries()[name](spark, tables[0]).collect()


def test_op2(spark, tables):
    fps = {}
    for i, t, _ in tables[1]:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), t.encode()))
        grams = [b" ".join(w[a : a + 3]) for a in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    root = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            least = min(root[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2)
            changed |= least < root[i]
            root[i] = min(root[i], least)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in run(spark, tables, "op2_simhash_near_dedup")} == {(i, f"{f:016x}", root[i]) for i, f in fps.items()}


def test_op3(spark, tables):
    want = {i for i, t, _ in tables[1] if decontam.myers(ITEM, decontam.fold(t), 7)[0] <= 7}
    assert {r.doc_id for r in run(spark, tables, "op3_benchmark_decontamination")} == want and want


def test_op5(spark, tables):
    got = {r.doc_id: r for r in run(spark, tables, "op5_secret_scan")}
    for i, t, _ in tables[1]:
        spans = sorted((m.start(), k, m.end(), r.kind) for k, r in enumerate(secrets.RULES) for m in re.finditer(r.pattern, t) if len(m.group(r.group)) >= r.least)
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert got[i].spans == joined and got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_op6(spark, tables):
    got, seen = {r.doc_id: r for r in run(spark, tables, "op6_suffix_array_dedup")}, set()
    for i, t, _ in sorted(tables[1]):
        b, gone = t.encode(), bytearray(len(t.encode()))
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(b[p : p + 100])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        assert (got[i].n_bytes, got[i].n_removed, got[i].kept_sha256) == (len(b), sum(gone), hashlib.sha256(kept).hexdigest())


def test_op8(spark, tables):
    got = run(spark, tables, "op8_source_mix")
    by = {}
    for i, t, s in tables[1]:
        by.setdefault(s, []).append(len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    total, names = sum(map(sum, by.values())), sorted(by, key=lambda s: (s is None, s or ""))
    weight, target = dict(zip(names, (5, 2, 1))), {}
    while True:  # reshare what is above three times a source's size
        open_ = [s for s in names if s not in target]
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 3 * sum(by[s])]
        target |= {s: 3.0 * sum(by[s]) for s in over} if over else {s: level * weight[s] for s in open_}
        if not over:
            break
    for s in names:
        own = [r for r in got if r.source_size == sum(by[s])]
        assert abs(own[0].target - target[s]) < 1e-6 and abs(sum(r.taken for r in own) - target[s]) <= 1
    assert all(r.taken <= 3 * r["size"] for r in got) and len(got) == len(tables[1])


@pytest.mark.parametrize("name, label", [("op4_toxicity", lambda i: i % 5 == 0), ("op10_quality", lambda i: True)])
def test_models_score_every_document(spark, tables, name, label):
    got = run(spark, tables, name)
    assert sorted(r.doc_id for r in got) == sorted(i for i, *_ in tables[1])
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    if name == "op4_toxicity":
        held = [r for r in got if r.held_out and r.doc_id < 60]
        assert all(r.predicted == int(label(r.doc_id)) for r in held) and held


def test_op7(spark, tables):
    import base64

    import tiktoken

    from tidemark.llm import token_counts

    with open(token_counts.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    coder = tiktoken.Encoding("own", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {r.doc_id: r.n_tokens for r in run(spark, tables, "op7_token_counts")} == {i: len(coder.encode_ordinary(t)) for i, t, _ in tables[1]}


def test_op9(spark, tables):
    rows = spark.read.parquet(f"{tables[0]}/embeddings.parquet").collect()
    x = {r.vec_id: np.array(r.embedding) / np.linalg.norm(r.embedding) for r in rows}
    got, hits = run(spark, tables, "op9_nearest_neighbours"), 0
    for q in (0, 50, 100):
        best = sorted((-float(x[q] @ v), i) for i, v in x.items() if i != q)[:5]
        hits += len({i for _, i in best} & {r.vec_id for r in got if r.query_id == q})
    assert hits >= 14 and len(got) == 15


def test_pipeline(spark, tables):
    got = {r.doc_id: r for r in run(spark, tables, "pipeline")}
    plain = {i for i, t, _ in tables[1] if t and i % 5 in (1, 2, 4) and i < 60}
    assert not any(ITEM in r.text or "idiot" in r.text or "abcdefghijkl0" in r.text for r in got.values())
    assert all(0 < r.taken <= 3 * r.size for r in got.values())
    # of a source whose target is at least its size every document is taken, of others some are
    names = {i: s for i, _, s in tables[1]}
    sizes, targets = {}, {names[i]: r.target for i, r in got.items()}
    for i in plain | {202}:
        text = re.sub("password = abcdefghijkl0", "[SECRET]", next(t for j, t, _ in tables[1] if j == i))
        sizes[names[i]] = sizes.get(names[i], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text))
    whole = {s for s, t in targets.items() if t >= sizes[s]}
    assert set(got) <= plain | {202} and "a" in whole and {i for i in plain | {202} if names[i] in whole} <= set(got)
    assert abs(sum(r.taken for r in got.values()) - sum(sizes.values())) <= len(targets) and set(targets) == set(sizes)
