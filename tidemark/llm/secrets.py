"""Secret scanning over an incremental blob ledger, in DataFrame operations only.

Each version of a path is addressed by the SHA-256 of its content. The ledger is a table of one
row per blob and rule version that has been scanned, with the spans found, clean blobs included.
A run joins the versions with the ledger, scans only pairs of a blob and a rule version that are
not yet there, appends them, and joins the findings back to every path that ever held the blob.

Spans are code-point offsets, end exclusive. A rule's pattern runs leftmost and without
overlaps; matches that fail the rule's length are dropped afterwards. Positions follow from
the lengths of the matches and of the pieces between them, summed within runs of about the
square root of their number and over the runs, so a text of very many matches stays cheap.

Null content is empty; empty tables give empty results; repeated rows stay repeated in
findings; a pair that the ledger holds twice counts once; spans that start together come in the
order of rules, then by end; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import let
from ..tables import new_path, read_table
from .common import cut, sets_aside


@dataclass(frozen=True)
class Rule:
    """kind: name in spans; pattern: as Java and RE2 both read it; group: the part that must
    have `least` characters (0: the whole match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        import hashlib

        return hashlib.sha256(f"{self.kind}\n{self.pattern}\n{self.group}\n{self.least}".encode()).hexdigest()[:16]


# Patterns of the contract (letters of the names in either case), then two more kinds.
BASE_RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),  # a run of hex digits is matched whole, so the length can stand in the pattern
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

SPANS = "array<struct<start:int,end:int>>"
LEDGER = f"blob string, rule_version string, kind string, spans {SPANS}"


def content_address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def in_runs(items: Column, start: Column, totals, walk, finish) -> Column:
    """aggregate() over a long array with a growing result, at a cost of its length to the power
    of 1.5 instead of 2: items are taken in runs of about the square root of their number.
    totals(state, run) is the state after a run; walk(state, item) the state after an item, whose
    growing field only holds what its run added; finish(state) takes that out of it."""

    def over(runs: Column) -> Column:
        return let(bounds(runs, start, totals), lambda first: F.flatten(F.transform(runs, lambda run, i: F.aggregate(run, walk(F.get(first, i), None), walk, finish))))

    return let(let(items, cut_into_runs), over)


def cut_into_runs(items: Column) -> Column:
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(items))).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(items) - 1), step), lambda i: F.slice(items, i + 1, step))


def bounds(runs: Column, start: Column, totals) -> Column:
    """The state before each run, and after the last."""
    step = lambda at, acc: F.struct(at.alias("at"), F.concat(acc["all"], F.array(at)).alias("all"))
    return F.aggregate(runs, F.struct(start.alias("at"), F.array(start).alias("all")), lambda acc, run: let(totals(acc["at"], run), lambda at: step(at, acc)), lambda acc: acc["all"])


def spans_of(text: Column, rule: Rule) -> Column:
    """The rule's spans in a text, in order."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.split(text, rule.pattern, -1)
    parts = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    size = lambda c: F.coalesce(F.length(c), F.lit(0))
    lengths = F.transform(F.arrays_zip(gaps.alias("g"), matches.alias("m"), parts.alias("p")), lambda x: F.struct(size(x["g"]).alias("g"), size(x["m"]).alias("m"), size(x["p"]).alias("p")))
    none = F.expr(f"cast(array() as {SPANS})")

    def walk(acc: Column, x: Column | None) -> Column:
        if x is None:
            return F.struct(acc.alias("at"), none.alias("out"))
        start = acc["at"] + x["g"]
        span = F.array(F.struct(start.alias("start"), (start + x["m"]).alias("end")))
        return F.struct((start + x["m"]).alias("at"), F.when(x["p"] >= rule.least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    total = lambda at, run: F.aggregate(run, at, lambda n, x: n + x["g"] + x["m"])
    return F.when(text.rlike(rule.pattern), in_runs(lengths, F.lit(0), total, walk, lambda acc: acc["out"])).otherwise(none)


def addressed(versions: DataFrame, path: str = "doc_id", content: str = "text") -> DataFrame:
    """path, content and blob of every version."""
    return versions.select(F.col(path).alias("path"), F.coalesce(F.col(content), F.lit("")).alias("content")).withColumn("blob", content_address(F.col("content")))


def scan_blobs(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, path: str = "doc_id", content: str = "text") -> DataFrame:
    """LEDGER rows of the pairs that the ledger (None: empty) lacks.

    versions: a row per version of a path."""
    blobs = addressed(versions, path, content).select("blob", "content").dropDuplicates(["blob"])
    none = F.expr("cast(array() as array<string>)")
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule_version").alias("seen"))  # at most one entry a rule
        blobs = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", none))
    else:
        blobs = blobs.withColumn("seen", none)
    found = [
        F.when(~F.array_contains("seen", r.version), F.struct(F.lit(r.version).alias("rule_version"), F.lit(r.kind).alias("kind"), spans_of(F.col("content"), r).alias("spans")))
        for r in rules
    ]
    return blobs.select("blob", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("f")).select("blob", "f.*")


def scan(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, path: str = "doc_id", content: str = "text") -> DataFrame:
    """Bring the ledger at ledger_path up to date with the versions, and return it whole.

    The fresh rows are appended by one job; a run that is stopped leaves the ledger as it was and
    is run again."""
    spark = versions.sparkSession
    known = read_table(spark, ledger_path, LEDGER)
    known = known if known.limit(1).count() else None
    scan_blobs(versions, known, rules, path, content).write.mode("append").parquet(ledger_path)
    return read_table(spark, ledger_path, LEDGER)


def findings_by_path(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path, blob and found (array of kind, start, end, by start, then in the order of rules)
    for every version, over the ledger rows of these rules."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    per_blob = (
        ledger.where(F.col("rule_version").isin([r.version for r in rules]) & (F.size("spans") > 0))
        .dropDuplicates(["blob", "rule_version"])
        .groupBy("blob")
        .agg(F.flatten(F.collect_list(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[F.col("kind")].alias("rank"), s["end"].alias("end"), F.col("kind").alias("kind"))))).alias("found"))
        .withColumn("found", F.array_sort("found"))
    )  # a blob has at most one row a rule here
    # a table of its own: the join below can then split the versions of a blob that many paths hold
    per_blob = cut(per_blob, "findings")
    empty = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string>>)")
    return paths.join(per_blob, "blob", "left").select("path", "blob", F.coalesce("found", empty).alias("found"))


def joined_spans(found: Column) -> Column:
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_digest(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """doc_id, counts a base kind, the SHA-256 of the base spans and all spans, for every row.
    Without a ledger_path the ledger is new and starts empty."""
    ledger = scan(docs, ledger_path or new_path(docs.sparkSession, "ledger"))
    found = findings_by_path(addressed(docs).select("path", "blob"), ledger)
    base = [r.kind for r in BASE_RULES]
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("path").alias("doc_id"),
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(joined_spans(F.filter("found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined_spans(F.col("found")).alias("spans"),
    )


@sets_aside("doc_id", "text", "n_chars")
def redact(docs: DataFrame, marker: str = "[SECRET]", ledger_path: str | None = None) -> DataFrame:
    """docs with every secret's span replaced by the marker; all columns kept, n_chars
    recomputed where present. Spans that overlap are replaced as one; null text stays null."""
    ledger = scan(docs, ledger_path or new_path(docs.sparkSession, "ledger"))
    found = findings_by_path(addressed(docs).select("path", "blob"), ledger).where(F.size("found") > 0).select("blob", "found").dropDuplicates(["blob"])
    found = cut(found.select(F.col("blob").alias("__blob"), F.col("found").alias("__spans")), "spans")
    text = F.col("text")
    # a run's part of the text, from the end of all spans before it to its own last end, is cut
    # out once, and its pieces out of that
    furthest = lambda at, run: F.aggregate(run, at, lambda n, s: F.greatest(n, s["end"]))
    nothing = F.expr("cast(array() as array<string>)")

    def cleaned(part: Column, run: Column, a: Column) -> Column:
        def walk(acc: Column, s: Column) -> Column:
            between = F.substring(part, acc["at"] - a + 1, s["start"] - acc["at"])
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.array(between, F.lit(marker)))).alias("out"))

        return F.aggregate(run, F.struct(a.alias("at"), nothing.alias("out")), walk, lambda acc: F.concat_ws("", acc["out"]))

    def over(runs: Column) -> Column:
        return let(bounds(runs, F.lit(0), furthest), lambda at: F.concat(F.concat_ws("", F.transform(runs, lambda run, i: each(run, F.get(at, i), F.get(at, i + 1)))), F.substring(text, F.element_at(at, -1) + 1, F.length(text))))

    def each(run: Column, a: Column, b: Column) -> Column:
        return let(F.when(b > a, F.substring(text, a + 1, b - a)).otherwise(""), lambda part: cleaned(part, run, a))

    walked = let(cut_into_runs(F.col("__spans")), over)
    out = docs.withColumn("__blob", content_address(text)).join(found, "__blob", "left")
    out = out.withColumn("text", F.when(F.col("__spans").isNull(), text).otherwise(walked))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
