"""Templates of many hosts against classes built by hand."""

import random
from collections import defaultdict

from tidemark.llm import html_extract
from tidemark.llm.html_extract import walk


def pages_of(rng, host, n):
    """Pages whose boxes have names that no list knows; each with its own text."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    said = lambda k: " ".join(word() for _ in range(k))
    name = [f"q{rng.randrange(1000)}{c}" for c in "abcdef"]
    box, offer, legal, shared = said(6), said(7), said(9), said(5)
    main = rng.choice(["article", "div"])
    out = []
    for i in range(n):
        own = [said(rng.randrange(8, 30)) for _ in range(rng.randrange(2, 6))]
        if i % 3 == 0:
            own.insert(1, shared)  # a sentence that pages share, in the article itself
        body = [f"<p>{p}</p>" for p in own]
        extra = ""
        if main == "article":
            body.insert(1, f'<div class="{name[3]}"><span>{offer}</span></div>')
        elif i % 3:
            extra = f'<div class="{name[4]}"><span>{offer}</span><i>x</i></div>'
        html = (
            f'<html><body><div class="{name[0]}"><span>{box}</span></div><{main} class="{name[1]}">{"".join(body)}</{main}>'
            f'{extra}<div class="{name[2]}"><span>{legal}</span></div></body></html>'
        )
        out.append((f"http://{host}/{i}", html, "\n".join(own)))
    return out


def brute_template(pages, support=0.5):
    """Keys of a host's template, by whole occurrence vectors."""
    vectors, places, texts, around = defaultdict(dict), defaultdict(dict), set(), {}
    article = lost = 0
    for i, page in enumerate(pages):
        for place, (kind, value, _, inside, path, box) in enumerate(walk(page)):
            value = " ".join(value.split()) if kind == "text" else value
            if not value:
                continue
            if kind == "text" and inside:
                article += len(value)
                if not box or box[0].split(" ")[0] in ("article", "main"):
                    continue
                around[kind, value, path] = ("tag", *box)
            key = kind, value, path
            vectors[key][i] = vectors[key].get(i, 0) + 1
            places[key].setdefault(i, place)
            if kind == "text":
                texts.add(key)
    often = {k: tuple(sorted(v.items())) for k, v in vectors.items() if len(v) >= support * len(pages)}
    often = {k: v for k, v in often.items() if k not in around or often.get(around[k]) == v}
    lost = sum(len(k[1]) * sum(vectors[k].values()) for k in often if k in around)
    if 2 * lost > article:
        often = {k: v for k, v in often.items() if k not in around}
    classes = defaultdict(list)
    for k, v in often.items():
        classes[v].append(k)
    classes = {v: ks for v, ks in classes.items() if len(ks) > 1}
    most = max((len(v), len(ks)) for v, ks in classes.items())
    roots = [v for v, ks in classes.items() if (len(v), len(ks)) == most]
    assert len(roots) == 1
    root = classes[roots[0]]
    gaps = lambda k: {sum(places[r][i] < place for r in root if i in places[r]) for i, place in places[k].items()}
    kept = set(classes[roots[0]])
    for v, ks in classes.items():
        if v != roots[0] and any(k in texts for k in ks) and len(set().union(*map(gaps, ks))) == 1:
            kept.update(ks)
    return {html_extract.token_key(*k) % (1 << 64) for k in kept}, {html_extract.token_key(*k) % (1 << 64) for k in kept & texts}


def test_templates_of_twenty_hosts(spark):
    rng = random.Random(11)
    hosts = {f"h{h}.example": pages_of(rng, f"h{h}.example", rng.randrange(6, 12)) for h in range(20)}
    rows = [(n, url, html, text) for n, (url, html, text) in enumerate(p for pages in hosts.values() for p in pages)]
    table = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string").repartition(7)
    keys, texts = defaultdict(set), defaultdict(set)
    for r in html_extract.template_tokens(html_extract.hosts(table)).collect():
        keys[r.host].add(r.key % (1 << 64))
        if r.is_text:
            texts[r.host].add(r.key % (1 << 64))
    for host, pages in hosts.items():
        want, constant = brute_template([html for _, html, _ in pages])
        assert (keys[host], texts[host]) == (want, constant), host
        assert len(constant) >= 3
    got = {r.page_id: r.text for r in html_extract.extract(table).collect()}
    assert got == {n: text for n, _, _, text in rows}
    without = {r.page_id: r.text for r in html_extract.extract(table, support=2.0).collect()}
    assert all(without[n] != got[n] for n in got)  # no name tells, so every page needs its template
