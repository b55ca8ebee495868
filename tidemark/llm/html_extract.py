"""Main text of web pages, with templates deduced from pages of the same host.

Tokens are tags and whole text nodes, told apart by their path of enclosing sections. The
occurrence vector of a token lists how often it occurs in each page of its host; tokens with
one vector form an equivalence class. Vectors are compared by a sum of hashes over
(page, count), which adds up in any order, so a host of any size is grouped by partial sums.
A class is valid if it has two tokens or more and at least `support` of the host's pages; the
largest class that all of these pages share is the root of the template, and another class
nests in it if in every page all its tokens lie in one gap between neighbouring root tokens. Text nodes of
the template are constant; what lies between are the slots.

A page's main text is read from the slots inside its article (or main) element, or from all
slots if it has none; sections that are never content by their name (menus, headers, footers,
asides, forms, notices, adverts, comments, scripts, styles) are then left out. An article's own
header and its paragraphs, whatever their names, are content. Inside an article
a text node is the template's only if the section around it, itself inside the article, is in
its class: a box that each page repeats, not a sentence that pages share. Hosts whose articles
would lose more than half of their text so hold copies of an article, and keep it; hosts of
fewer than `least_pages` pages have no template.

Null html is empty; an empty page or one without content has an empty text; null urls form a
host of their own; repeated rows are extracted each for itself; no pages give no rows; extra
columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|object|canvas|textarea|select)\b.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[/!?]?[a-z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# Elements that are never content, and names of such sections in class, id or role.
NEVER = frozenset("head nav header footer aside form button menu dialog fieldset".split())
NAMES = r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|sidebar\w*|aside|footer|breadcrumbs?|cookies?|consent|notices?|newsletter|subscribe|popup|modal|comments?|disqus\w*|respond|replies|share|sharing|social|related|widgets?|pagination|pager|login|search|navigation|complementary|contentinfo"
NEVER_NAMED = re.compile(rf"(?:^|[\s_-])(?:{NAMES}|header|masthead)(?:$|[\s_-])", re.I)
# inside an article a name is a whole one, or one with a word for a box behind it; headers are the article's own
BOX = r"(?:[_-]+(?:box|bar|block|area|list|links?|buttons?|icons?|widget|section|container|wrapper|wrap|inner|content|items?|posts?|articles?|stories|form|thread|\d+))*"
NEVER_NAMED_INSIDE = re.compile(rf"(?:^|\s)(?:[\w-]*[_-])?(?:{NAMES}){BOX}(?:$|\s)", re.I)
# elements of running text, which are no sections whatever their names
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 span em strong b i u a q cite code small sub sup mark time abbr blockquote pre li dt dd td th figcaption caption".split())
MAIN = frozenset(("article", "main"))
BLOCKS = frozenset("address article blockquote body br caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead title tr ul".split())
SECTIONS = frozenset("html head body header nav main article section aside footer div form table ul ol".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def left_out(name: str, named: str, inside: bool) -> bool:
    """Whether a section is never content by its element or names. Inside an article its header
    is the article's, and paragraphs, headlines and the like go by no name."""
    if name in NEVER:
        return not (inside and name == "header")
    if not named or name in MAIN or inside and name in RUNNING:
        return False
    return bool((NEVER_NAMED_INSIDE if inside else NEVER_NAMED).search(named))


def walk(page: str) -> Iterator[tuple[str, str, bool, bool, str, tuple[str, str] | None]]:
    """Tokens of a page: kind ('tag', 'text'), value, whether it lies in a section that is
    never content, whether it lies in an article, its path of sections, and the innermost of
    them as a token (value and path)."""
    stack: list[str] = []  # names
    tokens: list[tuple[str, str]] = []
    path = ""
    never, depth = "", 0  # the section being left out, and how deep its name is nested
    inside = 0
    last = 0
    for m in MARKUP.finditer(page):
        if m.start() > last:
            yield "text", page[last : m.start()], bool(never), inside > 0, path, tokens[-1] if tokens else None
        last = m.end()
        name = m.group(3)
        if not name:
            continue
        name, closing, rest = name.lower(), bool(m.group(2)), m.group(4)
        named = ""
        if not closing and "=" in rest:
            named = " ".join(filter(None, (a or b or c for a, b, c in NAMED.findall(rest))))
        if closing:
            if never and name == never:
                depth -= 1
                if not depth:
                    never = ""
            if name in MAIN and inside:
                inside -= 1
            if name in SECTIONS and name in stack:
                while stack.pop() != name:
                    tokens.pop()
                tokens.pop()
                path = tokens[-1][1] if tokens else ""
            yield "tag", "/" + name, bool(never), inside > 0, path, None
            continue
        if name in MAIN and never and not inside:
            never, depth = "", 0  # a section left open ends where the article begins
        bare = name in VOID or rest.endswith("/")
        if never:
            depth += name == never and not bare
        elif not bare and name not in ("html", "body") and left_out(name, named, inside > 0):
            never, depth = name, 1
        if name in MAIN and not bare:
            inside += 1
        value = f"{name} {named}" if named else name
        if name in SECTIONS and not bare:
            path = f"{path}/{value}"
            stack.append(name)
            tokens.append((value, path))
        yield "tag", value, bool(never), inside > 0, path, None
    if last < len(page):
        yield "text", page[last:], bool(never), inside > 0, path, tokens[-1] if tokens else None


def token_key(kind: str, value: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}\n{path}\n{value if kind == 'tag' else ' '.join(value.split())}".encode("utf-8", "surrogatepass"))


def page_tokens(page: str) -> tuple[dict[int, list], int]:
    """key: count, place of the first, whether it is text, the section's key (texts inside an
    article only, else 0) and characters of a page's tokens; and the characters of its article.
    Texts right below the article itself are no template's, so they are left out."""
    out: dict[int, list] = {}
    article = 0
    for place, (kind, value, _, inside, path, box) in enumerate(walk(page)):
        around = 0
        if kind == "text":
            value = " ".join(value.split())
            if not value:
                continue
            if inside:
                article += len(value)
                if not box or box[0].split(" ", 1)[0] in MAIN:
                    continue
                around = token_key("tag", *box)
        k = token_key(kind, value, path)
        if k in out:
            out[k][0] += 1
            out[k][4] += len(value)
        else:
            out[k] = [1, place, kind == "text", around, len(value)]
    return out, article


def main_text(page: str, constant: frozenset[int] | set[int] = frozenset()) -> str:
    """The page's main text; constant: keys of the template's text nodes."""
    found = {True: [[]], False: [[]]}  # blocks inside an article, and elsewhere
    has_main = False
    for kind, value, never, inside, path, _ in walk(page):
        if kind == "tag":
            name = value.split(" ", 1)[0].lstrip("/")
            if inside:
                has_main = True
            if name in BLOCKS or name in NEVER:
                for side in found.values():
                    if side[-1]:
                        side.append([])
        elif not never and not (constant and token_key(kind, value, path) in constant):
            found[inside][-1].append(value)
    blocks = (" ".join(entities.unescape("".join(b)).split()) for b in found[has_main])
    return "\n".join(b for b in blocks if b)


def hosts(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit(""))).alias("host"))


def template_tokens(pages: DataFrame, support: float = 0.5, least_pages: int = 3, broadcast_keys: int = 1_000_000) -> DataFrame:
    """host, key, is_text, place, class_id: the tokens of each host's template: those of the root, and
    of the classes that nest in it and hold texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, int], list] = {}
            for page_id, host, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found, article = page_tokens(page)
                whole = sums.setdefault((host, 0), [0, 0, 0, 0, 0, False])
                whole[1] += 1
                whole[3] += article
                for k, (count, place, is_text, around, chars) in found.items():
                    s = sums.setdefault((host, k), [0, 0, 0, 0, around, is_text])
                    s[0] += xxhash.xxh64_intdigest(f"{page_id}:{count}")
                    s[1] += 1
                    s[2] += place
                    s[3] += chars
            cols = list(zip(*sums.values())) or [[]] * 6
            u64 = lambda c: pa.array(np.array(c, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in sums], pa.string()), u64([k for _, k in sums]), u64([x % (1 << 64) for x in cols[0]]), *(pa.array(list(c), pa.int64()) for c in cols[1:4]), u64(cols[4]), pa.array(list(cols[5]), pa.bool_())],
                names=["host", "key", "sig", "pages", "places", "chars", "around", "is_text"],
            )

    rows = pages.select("page_id", "host", "html").mapInArrow(run, "host string, key bigint, sig bigint, pages bigint, places bigint, chars bigint, around bigint, is_text boolean")
    # the hash sums add up modulo 2**64: as two halves, which no sum here overflows
    low, high = F.col("sig").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("sig", 32)
    total = [F.sum(n).alias(n) for n in ("pages", "places", "chars")]
    t = rows.groupBy("host", "key").agg(F.sum(low).alias("low"), F.sum(high).alias("high"), *total, F.max("around").alias("around"), F.max("is_text").alias("is_text"))
    vector = F.struct(F.col("low").bitwiseAND(F.lit(0xFFFFFFFF)).alias("l"), (F.col("high") + F.shiftrightunsigned("low", 32)).bitwiseAND(F.lit(0xFFFFFFFF)).alias("h"))
    t = cut(t.withColumn("vector", vector).drop("low", "high"), "tokens")
    sizes = t.where("key = 0").select("host", F.col("pages").alias("n"), F.col("chars").alias("article"))
    t = t.where("key <> 0").join(sizes.where(F.col("n") >= least_pages), "host").where(F.col("pages") >= F.col("n") * support)
    # from here on a host has at most 1 / support times the tokens of its pages' mean
    boxes = t.where("not is_text").select("host", F.col("key").alias("around"), F.col("vector").alias("box"))
    t = t.join(boxes, ["host", "around"], "left").where((F.col("around") == 0) | (F.col("box") == F.col("vector")))
    lost = F.sum(F.when(F.col("around") != 0, F.col("chars")).otherwise(0)).over(W.partitionBy("host"))
    t = t.withColumn("lost", lost).where((F.col("around") == 0) | (2 * F.col("lost") <= F.col("article")))
    of_class = W.partitionBy("host", "vector")
    t = t.withColumn("size", F.count("*").over(of_class)).where("size > 1").withColumn("place", F.col("places") / F.col("pages"))
    t = t.withColumn("root", F.max(F.struct("pages", "size", "vector")).over(W.partitionBy("host"))["vector"] == F.col("vector"))
    t = cut(t.withColumn("told", F.max("is_text").over(of_class)).where("root or told"), "classes")
    gaps = _gaps(pages, t, broadcast_keys)
    t = t.join(gaps, ["host", "key"], "left")
    t = t.withColumn("nests", F.col("root") | (F.min("first").over(of_class) == F.max("last").over(of_class)))
    return t.where("nests").select("host", "key", "is_text", "place", F.hash("vector").alias("class_id"))


def _by_host(pages: DataFrame, lists: DataFrame, keys: int, broadcast_keys: int, how: str) -> DataFrame:
    """Pages with their host's lists of keys: a broadcast while these are at most broadcast_keys."""
    return pages.join(F.broadcast(lists) if keys <= broadcast_keys else lists, "host", how)


def _gaps(pages: DataFrame, t: DataFrame, broadcast_keys: int) -> DataFrame:
    """host, key, first, last: the least and the largest gap of the root in which pages hold a
    token of the other classes, a gap being the number of root tokens that come before it in
    that page. Only pages of hosts with such classes are read again."""
    lists = t.groupBy("host").agg(F.collect_set(F.when(F.col("root"), F.col("key"))).alias("roots"), F.collect_set(F.when(~F.col("root"), F.col("key"))).alias("others"))
    lists = cut(lists.where(F.size("others") > 0), "roots")
    size = lists.agg(F.coalesce(F.sum(F.size("roots") + F.size("others")), F.lit(0))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, int], list[int]] = {}
            for host, page, roots, others in zip(*(batch.column(i).to_pylist() for i in range(4))):
                found, _ = page_tokens(page)
                places = sorted(found[k % (1 << 64)][1] for k in roots if k % (1 << 64) in found)
                for k in others:
                    if k % (1 << 64) in found:
                        gap = bisect_left(places, found[k % (1 << 64)][1])
                        s = seen.setdefault((host, k), [gap, gap])
                        s[0], s[1] = min(s[0], gap), max(s[1], gap)
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in seen], pa.string()), pa.array([k for _, k in seen], pa.int64()), *(pa.array([s[i] for s in seen.values()], pa.int32()) for i in (0, 1))],
                names=["host", "key", "first", "last"],
            )

    met = _by_host(pages, lists, size, broadcast_keys, "inner").select("host", "html", "roots", "others")
    rows = met.mapInArrow(run, "host string, key bigint, first int, last int")
    return rows.groupBy("host", "key").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def extract(pages: DataFrame, broadcast_keys: int = 1_000_000, **options) -> DataFrame:
    """page_id, url, text, n_chars for every page. The templates go to the executors as a
    broadcast while their text tokens number at most broadcast_keys, by a join beyond it."""
    pages = hosts(pages)
    constant = cut(template_tokens(pages, broadcast_keys=broadcast_keys, **options).where("is_text").groupBy("host").agg(F.collect_set("key").alias("constant")), "templates")
    size = constant.agg(F.coalesce(F.sum(F.size("constant")), F.lit(0)) + F.count("*")).first()[0]
    joined = _by_host(pages, constant, size, broadcast_keys, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, {k % (1 << 64) for k in c or ()}) for p, c in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return joined.select("page_id", "url", "html", "constant").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
