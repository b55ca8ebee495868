"""One odd table through the pipeline's stages: clashing names, nulls, repeats, long texts, no rows."""

import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import ann, decontam, mixing, near_copies, quality_crf, secrets, toxicity

CLASHES = ["_row", "__doc", "_doc", "__blob", "__spans", "blob", "found", "_src", "_h", "_nth", "key", "c", "row", "keys", "__column0", "a", "b", "label", "item_id", "text_", "start", "size_"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHES) + ", notes map<string,string>, more array<struct<m:map<string,int>>>"
ITEM = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *[f"{c}!" for c in CLASHES], {"k": "v"}, [({"k": 1},)]) for i, t, s in rows], SCHEMA)


def words(seed, n=40):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


ROWS = [(1, None, None), (2, "", "a"), (3, words(3), "a"), (3, words(3), "a"), (None, words(3) + " end", "b"), (4, "x" * 1_000_000, None), (5, f"{words(5)} {ITEM} {words(6)}", "a"), (6, f"password = abcdefghijkl0 {words(7)}", "b"), (7, words(8, 30_000), "b"), (6, words(9), "a")]

STAGES = {
    "near_copies": lambda spark, d: near_copies.first_of_each(d),
    "decontaminate": lambda spark, d: decontam.decontaminate(d, spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id bigint, text string")),
    "redact": lambda spark, d: secrets.redact(d),
    "mixed": lambda spark, d: mixing.mixed_documents(d),
    "toxic": lambda spark, d: toxicity.drop_toxic(d, spark.createDataFrame([(3, 0), (5, 0), (7, 1)], "doc_id bigint, toxic int")),
}
KEPT = {
    "near_copies": Counter([1, 3, 4, 5, 6, 6, 7]),
    "decontaminate": Counter([1, 2, 3, 3, None, 4, 6, 6, 7]),
    "redact": Counter(r[0] for r in ROWS),
}


@pytest.mark.parametrize("name", STAGES)
def test_columns_and_rows_are_kept(spark, name):
    odd = table(spark, ROWS)
    out = STAGES[name](spark, odd)
    extra = ["size", "target", "taken"] if name == "mixed" else []
    assert out.columns == odd.columns + extra
    got = [r.asDict() for r in out.collect()]
    assert all(r[c] == f"{c}!" for r in got for c in CLASHES) and all(r["notes"] == {"k": "v"} and r["lang"] == "en" for r in got)
    if name in KEPT:
        assert Counter(r["doc_id"] for r in got) == KEPT[name]
    if name == "redact":
        text = {r["doc_id"]: r["text"] for r in got if r["doc_id"] != 6}
        assert text == {i: t for i, t, _ in ROWS if i != 6} and any("[SECRET]" in (r["text"] or "") for r in got) and not any("abcdefghijkl0" in (r["text"] or "") for r in got)
    elif name == "mixed":
        assert {r["doc_id"] for r in got} <= {3, None, 4, 5, 6, 7} and all(0 < r["taken"] <= 3 * r["size"] for r in got)
    else:
        assert {(r["doc_id"], r["text"]) for r in got} <= {(i, t) for i, t, _ in ROWS}
    none = STAGES[name](spark, table(spark, []))
    assert none.collect() == [] and none.columns == out.columns


@pytest.mark.parametrize("scale", [1e200, 1e-170, 1e-320, 1.0])
def test_cosines_of_any_scale(spark, scale):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 5)) * np.array([scale] + [1.0] * 59)[:, None] if scale < 1 else rng.standard_normal((60, 5)) * scale
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.nearest(v, v.where("vec_id % 50 = 0")).collect()
    unit = x / np.abs(x).max(1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    assert len(got) == 10
    for q in (0, 50):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        want = sorted((-float(unit[q] @ unit[i]), i) for i in range(60) if i != q)[:5]
        assert [r.vec_id for r in mine] == [i for _, i in want] and np.allclose([r.score for r in mine], [-s for s, _ in want])


def test_quality_tells_junk_from_prose(spark):
    rng, rows, labels = random.Random(5), [], []
    for i in range(400):
        good = i % 2 == 0
        lines = [words(rng.random(), 12).capitalize() + "." for _ in range(6)] if good else [" | ".join(words(rng.random(), 1) for _ in range(3)) + " >>> $$$ %%% 1234" for _ in range(6)]
        rows.append((i, "\n".join(lines), "s"))
        labels.append((i, int(good)))
    got = quality_crf.quality_digest(table(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 400 and len(held) > 50
    assert sum(r.predicted == int(r.doc_id % 2 == 0) for r in held) >= 0.95 * len(held)
