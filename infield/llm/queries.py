"""The queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from infield.llm import bpe, centroids, chat_windows, decontaminate, html_text, jaccard_join, language_id, licenses, neighbours, quality, secret_scan, url_filter, whitening
from infield.llm.common import scan

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


#: The production rules of the URL filter.
RULES = [url_filter.parse_rule(*r) for r in (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return url_filter.judge(scan(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict", "score", "threshold")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, number of links and group of near copies of every document."""
    return jaccard_join.similar(scan(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    return language_id.identify(scan(spark, sf_dir, "documents"))


def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of one made of control strings, read back from its formatted windows."""
    probe = spark.sql("SELECT -1L AS conv_id, t.turn, t.role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    turns = scan(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat_windows.read_back(chat_windows.windows(turns))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every 20th vector."""
    vectors = scan(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's tokens and of what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    docs = scan(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN).select("doc_id", "ids")
    return bpe.digests(encoded, path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license of every document, taken as a file in a directory of its source and language."""
    docs = scan(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan_licenses(docs.select("doc_id", path.alias("path"), "text"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark text, with that text."""
    return decontaminate.leaks(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy of every document under the model of trusted text, and whether its language's quantiles keep it."""
    docs = scan(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.classify(docs, scan(spark, sf_dir, "labels")).select("doc_id", "lang", "cross_entropy", F.exp("cross_entropy").alias("perplexity"), "symbols", "keep")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = scan(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages, html_text.learn(pages)).select("page_id", "url", "text", "n_chars")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after ten rounds from eight drawn centroids."""
    return centroids.cluster(scan(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every vector."""
    return whitening.whiten(scan(spark, sf_dir, "embeddings"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, each taken as a version of a file."""
    found = secret_scan.scan_versions(scan(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secret_scan.BASE]
    counts = [F.size(secret_scan.of_kinds(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(secret_scan.as_text(secret_scan.of_kinds(F.col("spans"), *base)), 256).alias("base_sha256"), secret_scan.as_text(F.col("spans")).alias("spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_url_filter, op2_jaccard_join, op3_language_id, op4_chat_windows, op5_neighbours, op6_byte_bpe, op7_licenses, op8_decontamination, op9_quality, op10_html_text, op11_centroids, op12_whitening, op13_secrets]
    return {f.__name__: f for f in named}


def _escaped_length(column: str) -> str:
    """Length of an escaped text: a backslash more for each backslash and each control string."""
    return f"(length({column}) + length({column}) - length(replace({column}, '\\', '')) + len(regexp_extract_all({column}, '</?s>|\\[/?INST\\]')))"


CHAT_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
t AS (SELECT *, {len(chat_windows.OPEN + chat_windows.MIDDLE + chat_windows.CLOSE)} + {_escaped_length("role")} + {_escaped_length("text")} AS tokens, row_number() OVER w AS nth FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, min(CASE WHEN role = 'system' THEN nth END) OVER (PARTITION BY conv_id) AS system FROM t),
s AS (SELECT conv_id, before // {chat_windows.SPAN} AS span, min(nth) AS first, min(before) AS start, sum(tokens) AS own FROM p GROUP BY ALL),
h AS (SELECT s.conv_id, s.span, sum(p.tokens) AS old FROM s JOIN p ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.nth < s.first AND (p.nth = p.system OR p.before >= s.start - {chat_windows.HISTORY}) GROUP BY ALL),
f AS (SELECT s.conv_id, sum(s.own + coalesce(h.old, 0)) AS chars FROM s LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM s.conv_id AND h.span = s.span GROUP BY s.conv_id),
a AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth) AS turns, coalesce(string_agg(text, '' ORDER BY nth) FILTER (WHERE role = 'assistant'), '') AS loss FROM t GROUP BY conv_id)
SELECT a.conv_id, a.n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(f.chars AS BIGINT) AS formatted_chars FROM a JOIN f ON f.conv_id IS NOT DISTINCT FROM a.conv_id
"""


#: Integer vectors in long form, the drawn centroids, ten rounds written out, and the last assignment.
CENTROIDS_SQL = (
    """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS xs
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64 AND len(embedding) = 64),
e AS MATERIALIZED (SELECT rid, unnest(range(1, 65)) AS d, unnest(xs) AS x FROM v),
drawn AS (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), xs) - 1 AS k, xs FROM v QUALIFY k < 8),
c0 AS MATERIALIZED (SELECT k, unnest(range(1, 65)) AS d, unnest(xs) AS x FROM drawn),
"""
    + "".join(
        f"""a{i} AS MATERIALIZED (SELECT e.rid, c.k, sum((e.x - c.x) * (e.x - c.x)) AS far FROM e JOIN c{i} c USING (d) GROUP BY e.rid, c.k QUALIFY row_number() OVER (PARTITION BY e.rid ORDER BY far, c.k) = 1),
m{i} AS (SELECT a.k, e.d, sum(e.x) AS s, count(*) AS n FROM a{i} a JOIN e USING (rid) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT c.k, c.d, coalesce((s - ((s % n) + n) % n) // n, c.x) AS x FROM c{i} c LEFT JOIN m{i} USING (k, d)),
"""
        for i in range(10)
    )
    + """a10 AS MATERIALIZED (SELECT e.rid, c.k, sum((e.x - c.x) * (e.x - c.x)) AS far FROM e JOIN c10 c USING (d) GROUP BY e.rid, c.k QUALIFY row_number() OVER (PARTITION BY e.rid ORDER BY far, c.k) = 1),
h AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS digest FROM c10 GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(far AS BIGINT) AS distance, CAST(sum(far) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(far) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a10 JOIN v USING (rid) JOIN h USING (k)
"""
)


def _secret_sql(rule: secret_scan.Rule, at: int) -> str:
    """Spans of one rule: matches are put between two control characters, and what lies before each gives its place."""
    pattern = rule.pattern.replace("'", "''")
    checked = f"regexp_extract(hit, '{pattern}', {rule.group})" if rule.group else "hit"
    return f"""SELECT rid, '{rule.kind}' AS kind, {at} AS nr, first AS start, first + len(hit) AS stop FROM (
  SELECT rid, split_part(part, chr(2), 1) AS hit, nth, coalesce(sum(len(part) - CASE WHEN nth > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM (SELECT rid, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS nth FROM (SELECT rid, string_split(regexp_replace(text, '({pattern})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS parts FROM doc) WHERE len(parts) > 1)
) WHERE nth > 1 AND len({checked}) >= {rule.least}"""


SECRETS_SQL = f"""
WITH doc AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
span AS MATERIALIZED ({" UNION ALL ".join(_secret_sql(r, i) for i, r in enumerate(secret_scan.RULES))}),
told AS (SELECT rid, {", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.BASE)},
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nr) FILTER (WHERE nr < {len(secret_scan.BASE)}), '') AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nr) AS spans FROM span GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN told USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    """What SQL can say; the other operators are models, searches or codes, tested against brute force."""
    return {"op4_chat_windows": CHAT_SQL, "op11_centroids": CENTROIDS_SQL, "op13_secrets": SECRETS_SQL}
