"""The operators' queries, and SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, fim, html_extract, langid, mixing, quality_crf, sa_dedup, secrets, simhash, token_counts, toxicity, variants


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex64("fp").alias("fingerprint"), "component_id")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sa_dedup.dedup_digest(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_counts(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_simhash_near_dedup, op3_benchmark_decontamination, op4_toxicity, op5_secret_scan, op6_suffix_array_dedup, op7_token_counts, op8_source_mix, op9_nearest_neighbours, op10_quality, op11_spelling_variants, op12_fill_in_middle, op13_language_id)}


def _sql_spans(rank: int, rule: secrets.Rule) -> str:
    """rid, kind, rank, s, e of a rule's matches: each starts after the pieces and matches before it."""
    p = rule.pattern.replace("'", "''")
    length = lambda what: f"coalesce(list_sum(list_transform({what}, lambda x: length(x))), 0)"
    return f"""SELECT rid, '{rule.kind}' AS kind, {rank} AS rank, s, s + length(m[i]) AS e FROM (
      SELECT *, CAST({length("g[1:i]")} + {length("m[1:i-1]")} AS BIGINT) AS s FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT rid, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {rule.group}) AS part, string_split_regex(t, '{p}') AS g FROM d))) WHERE length(part[i]) >= {rule.least}"""


_BASE_KINDS = ", ".join(f"'{r.kind}'" for r in secrets.BASE_RULES)
_JOINED = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e)"

SQL: dict[str, str] = {
    "op5_secret_scan": f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
  spans AS ({" UNION ALL ".join(_sql_spans(i, r) for i, r in enumerate(secrets.RULES))}),
  per AS (SELECT rid, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("assign", "access", "hex"))}, {_JOINED} FILTER (kind IN ({_BASE_KINDS})) AS base, {_JOINED} AS spans FROM spans GROUP BY rid)
  SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN per USING (rid)""",
    # every 100-byte window as hex digits; a window is a repeat unless it is the first of its kind, and what repeats cover goes
    "op6_suffix_array_dedup": """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
  w AS (SELECT doc_id, p, md5(substr(h, CAST(2 * p + 1 AS BIGINT), 200)) AS k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM d)),
  r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS i FROM w) WHERE i > 1),
  runs AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (
    SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS new FROM r)) GROUP BY doc_id, run),
  cuts AS (SELECT doc_id, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id),
  kept AS (SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    CASE WHEN n_spans IS NULL THEN h ELSE array_to_string(list_transform(range(1, n_spans + 2), lambda i: substr(h, CAST(2 * (CASE WHEN i = 1 THEN 0 ELSE ends[i - 1] END) + 1 AS BIGINT), CAST(2 * ((CASE WHEN i > n_spans THEN length(h) // 2 ELSE starts[i] END) - (CASE WHEN i = 1 THEN 0 ELSE ends[i - 1] END)) AS BIGINT))), '') END AS k
    FROM d LEFT JOIN cuts USING (doc_id))
  SELECT doc_id, n_bytes, n_removed, n_spans, sha256(unhex(k)) AS kept_sha256 FROM kept""",
    # crc32 by its table; near words meet by what is left of both without one code point
    "op11_spelling_variants": f"""WITH RECURSIVE tab AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), i) AS c FROM (SELECT unnest(range(256)) AS i))),
  runs AS (SELECT id, word, count(*) AS n FROM (SELECT id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{6,}}')), '{variants.UPPER}', '{variants.LOWER}') AS word FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, text FROM documents)) GROUP BY ALL),
  hashed AS (SELECT word, n, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(id || ':' || word)), '..'), lambda b: CAST('0x' || b AS BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM runs, tab),
  v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(word, 1, h % length(word)) || substr(word, h % length(word) + 2) ELSE word END AS word, n FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
  less AS MATERIALIZED (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM v)),
  near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
    UNION SELECT l.word, v.word, v.n FROM less l JOIN v ON l.rest = v.word UNION SELECT v.word, l.word, l.n FROM less l JOIN v ON l.rest = v.word),
  best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
  f AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n FROM v LEFT JOIN best USING (word)),
  steps AS (SELECT word, word AS at FROM f UNION SELECT s.word, f.form FROM steps s JOIN f ON f.word = s.at WHERE f.form IS NOT NULL),
  roots AS (SELECT s.word, s.at AS root FROM steps s JOIN f ON f.word = s.at WHERE f.form IS NULL)
  SELECT word, form, root, n, n_near, form_n FROM f JOIN roots USING (word)""",
    "op12_fill_in_middle": """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
  c AS (SELECT *, string_split(t, chr(10)) AS parts, length(t) - length(replace(t, chr(10), '')) + CASE WHEN t = '' OR ends_with(t, chr(10)) THEN 0 ELSE 1 END AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
  k AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM c),
  x AS (SELECT *, CASE WHEN a = n THEN length(t) WHEN a = 0 THEN 0 ELSE length(array_to_string(parts[1:a], chr(10))) + 1 END AS i, CASE WHEN b = n THEN length(t) WHEN b = 0 THEN 0 ELSE length(array_to_string(parts[1:b], chr(10))) + 1 END AS j FROM k),
  y AS (SELECT *, substr(t, 1, i) AS prefix, substr(t, i + 1, j - i) AS middle, substr(t, j + 1) AS suffix, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM x)
  SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM y""",
}
