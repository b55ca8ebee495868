"""Spelling variants, fill-in-middle and language against brute force."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fim, langid, variants

ODD = "doc_id bigint, text string, lang string, n bigint, word string, output string, form string, h1 string"


def odd(spark, rows):
    """Documents whose further columns bear names that the operators use."""
    return spark.createDataFrame([(i, t, g, 1, "w", "o", "f", "h") for i, t, g in rows], ODD)


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def test_neighbourhoods_hold_all_that_one_edit_makes():
    rng = np.random.default_rng(3)
    for symbols in (2, 5):
        for _ in range(30):
            w = "".join(rng.choice(list("abcdeé"), 6))
            made = {w[:i] + w[i + 1 :] for i in range(6)} | {w[:i] + x + w[i + k :] for i in range(6 + 1) for x in "abcdeé" for k in (0, 1)} | {w}
            want = {int(variants.reduced_hash([m], symbols)[0]) for m in made}
            assert want <= set(variants.neighbour_hashes([w], symbols)[0].tolist())


@pytest.mark.parametrize("crowd", [4096, 1])
def test_variants_against_brute_force(spark, crowd):
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcxyzéü"), rng.integers(6, 9))) for _ in range(40)]
    made = {w: int(rng.integers(5, 2000)) for w in base}
    for w in base:
        for _ in range(6):
            i = int(rng.integers(0, len(w)))
            made.setdefault(str(rng.choice([w[:i] + w[i + 1 :], w[:i] + "q" + w[i + 1 :], w[:i] + "z" + w[i:]])), int(rng.integers(5, 60)))
    made |= {"x" * 5000: 50, "x" * 4999: 7, "x" * 4998 + "yx": 7}
    got = {r.word: r for r in variants.variants(spark.createDataFrame(list(made.items()), "word string, n bigint"), crowd=crowd).collect()}
    assert set(got) == set(made)
    forms = {}
    for w, n in made.items():
        others = [v for v in made if near(w, v)]
        best = min(others, key=lambda v: (-made[v], v), default=None)
        forms[w] = best if best and made[best] >= 5 * n else None
        assert (got[w].n_near, got[w].form, got[w].form_n) == (len(others), forms[w], made[best] if forms[w] else None)
    for w in made:
        root = w
        while forms[root]:
            root = forms[root]
        assert got[w].root == root


def test_words_of_odd_texts(spark):
    rows = [(i, f"Éditions, WORDÉS{i % 3} wordés_Ünited ab×cde÷f x{'y' * 9}", "a") for i in range(400)] + [(None, "Zebras zebras zebras zebras ZEBRAS", None), (7, None, "a"), (7, "", "a"), (8, "k" * 200_000, "a")] * 2
    count = Counter()
    for i, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    want = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    got = variants.spelling_variants(odd(spark, rows)).collect()
    assert {r.word: r.n for r in got} == want and len(want) > 5
    assert variants.spelling_variants(odd(spark, [])).collect() == []


LINES = ["", "a", "\n", "\n\n", "a\nb", "a\nb\n", "é\r\nüß\n\n x", "no <P> here", "ends <M>", "x" * 70_000 + "\n" + "é" * 70_000, "\n" * 1000, "<\nS>\nP", "😀\n😀é\n"]


@pytest.mark.parametrize("unit, pattern", [("line", r"[^\n]*\n|[^\n]+"), ("char", r"(?s).")])
def test_fill_in_middle_against_splitting(spark, unit, pattern):
    rng = np.random.default_rng(9)
    texts = LINES + ["".join(rng.choice(list("ab\né😀 "), rng.integers(1, 60))) for _ in range(150)]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(None, "a\nb\nc", None), (5, None, None), (5, "a\nb\n", None), (5, "a\nb\n", None)]
    made = fim.fill_in_middle(odd(spark, rows), unit=unit, rate=90, spm_rate=30).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    want = []
    for i, t, _ in rows:
        t, h = t or "", hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
        h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
        units = re.findall(pattern, t)
        n = len(units)
        a, b = sorted(x % (n + 1) for x in h[:2])
        p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
        form = "plain" if not t or re.search("<[PSM]>", t) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 30 else "psm"
        out = {"plain": t, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        want.append((i, n, form, None if form == "plain" else len(p), None if form == "plain" else len(m), out, t))
    got = [tuple(r) for r in made.collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert fim.fill_in_middle(odd(spark, [])).collect() == []


def test_digests_of_texts_in_many_groups(spark, monkeypatch):
    rows = [(i, "line\n" * i + "é" * (i % 5), None) for i in range(200)]
    assert list(fim.groups([5, 5, 20, 1, 1], 10)) == [(0, 2), (2, 3), (3, 5)]
    got = {r.doc_id: r for r in fim.digests(odd(spark, rows)).collect()}
    assert all(got[i].restored_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t, _ in rows) and len(got) == 200


def segmentations(word, known):
    """All ways to cut a word into pieces; a code point that is none is its bytes."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        head = [known[word[:k]]] if word[:k] in known else list(word.encode()) if k == 1 else None
        if head and k == 1 and word[0] not in known:
            head = [tuple(word[0].encode())]
        if head:
            yield from (head + rest for rest in segmentations(word[k:], known))


def test_forward_and_expected_counts_by_enumeration(monkeypatch):
    rng = np.random.default_rng(2)
    names = ["▁", "a", "b", "▁a", "ab", "ba", "aba", "bab", "▁ab", "aa"]
    known = {n: i for i, n in enumerate(names, 256)}
    trie = langid.Trie(known)
    logp = np.log(rng.dirichlet(np.ones(trie.none), 3).T)
    logp = np.vstack([logp, np.full(3, langid.NONE)])
    edge = lambda x, g: max(logp[list(x), g].sum(), langid.FLOOR) if isinstance(x, tuple) else logp[x, g]
    words = ["▁" + "".join(w) for n in (1, 4) for w in itertools.product("abé", repeat=n)]
    for n in (2, 5):
        some = [w for w in words if len(w) == n]
        got = langid.forward(langid.lattice(some, trie), logp)
        counts = np.zeros((trie.none + 1, 1))
        for i, w in enumerate(some):
            ways = list(segmentations(w, known))
            scores = np.array([[sum(edge(x, g) for x in way) for g in range(3)] for way in ways])
            assert np.allclose(got[i], np.logaddexp.reduce(scores, 0))
            for way, share in zip(ways, np.exp(scores[:, 1] - np.logaddexp.reduce(scores[:, 1]))):
                for x in way:
                    for y in x if isinstance(x, tuple) else (x,):
                        counts[y, 0] += share * (i + 1)
        for short in (16, 1):  # in plain numbers and in logarithms
            into = np.zeros(trie.none + 1)
            monkeypatch.setattr(langid, "RESCALE", short)
            langid.expected(langid.lattice(some, trie), logp[:, [1]], np.arange(1.0, len(some) + 1), into)
            assert np.allclose(into, counts[:, 0])
            assert np.allclose(langid.forward(langid.lattice(some, trie), logp), got)


def test_text_score_is_the_product_of_its_words():
    trie = langid.Trie({"▁the": 256, "▁": 257, "t": 258, "h": 259, "e": 260})
    model = langid.Model(trie, ["x", "y"], np.vstack([np.log(np.random.default_rng(0).dirichlet(np.ones(trie.none), 2).T), np.full(2, langid.NONE)]), np.zeros(2))
    texts = ["The the, het!", "", None, "1234 ?!", "the " * 5000 + "h" * 100_000]
    got, lettered = langid.text_scores(texts, model)
    assert lettered.tolist() == [True, False, False, False, True]
    assert np.allclose(got[0], 2 * model.word_scores(["the"])[0] + model.word_scores(["het"])[0])
    assert np.allclose(got[4], 5000 * model.word_scores(["the"])[0] + model.word_scores(["h" * 100_000])[0]) and np.isfinite(got).all()


def test_language_of_odd_and_held_out_texts(spark):
    rng = np.random.default_rng(4)
    stock = {"de": "der die das und schön straße nicht über".split(), "en": "the and of with thing through which".split(), "fr": "le la où être eau très une".split()}
    rows = [(i, " ".join(rng.choice(stock[g], 12)), g) for i, g in enumerate(list(stock) * 60)]
    rows += [(901, None, "de"), (902, "", "en"), (903, "12 + 34", "fr"), (None, "the thing", None), (905, "the thing", None), (905, "the thing", None), (906, "漢字", "zh"), (907, "straße " * 20000, None)]
    got = langid.language_digest(odd(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2)
    said = {r.doc_id: r.lang_pred for r in got}
    assert [said[i] for i in (901, 902, 903)] == ["und"] * 3 and {said[None], said[905]} == {"en"} and said[907] == "de"
    held = [(r.lang_pred, rows[r.doc_id][2]) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 180]
    assert len(held) > 20 and all(a == b for a, b in held)
    assert langid.language_digest(odd(spark, [])).collect() == []
    none = langid.language_digest(odd(spark, [(1, "the thing", None), (2, "x", None)])).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert math.isclose(sum(np.exp(langid._table(np.ones((300, 2))))[:-1, 0]), 1.0)


def test_more_languages_than_the_bound(spark):
    with pytest.raises(ValueError):
        langid.fit(odd(spark, [(i, "abc", f"l{i}") for i in range(4)]), most_languages=3)
