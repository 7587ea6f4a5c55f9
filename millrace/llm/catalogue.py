"""Queries of the training-data operators, with SQL where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalogue.registry import Entry, Query, table
from millrace.llm import hard_negatives, posting_lists, quality
from millrace.llm.byte_bpe import ByteBpe
from millrace.llm.decontaminate import contaminated
from millrace.llm.dialogue_repair import damaged, repair, report
from millrace.llm.exact_substrings import remove_repeats
from millrace.llm.language_id import fit as fit_languages
from millrace.llm.language_id import language, remainder
from millrace.llm.sanitise import KINDS, TERM, find_personal_data
from millrace.llm.secret_scan import BASE_RULES, find_secrets
from millrace.llm.simhash_dedup import near_duplicates
from millrace.llm.token_groups import jaccard_components
from millrace.llm.url_filter import judge
from millrace.storage import scratch_path

LLM_ENTRIES: dict[str, Entry] = {}


def llm_query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(fn: Query) -> Query:
        LLM_ENTRIES[fn.__name__] = Entry(fn, sql)
        return fn

    return add


_SECRETS_SQL = r"""
WITH kinds(place, kind, least) AS (VALUES (0, 'assign', 12), (1, 'access', 18), (2, 'hex', 16)),
texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cut AS (
    SELECT doc_id, 0 AS place, regexp_extract_all(t, '{assign}') AS hits, regexp_extract_all(t, '{assign}', 2) AS sized,
           string_split_regex(t, '{assign}') AS gaps FROM texts
    UNION ALL SELECT doc_id, 1, regexp_extract_all(t, '{access}'), regexp_extract_all(t, '{access}'), string_split_regex(t, '{access}') FROM texts
    UNION ALL SELECT doc_id, 2, regexp_extract_all(t, '{hex}'), regexp_extract_all(t, '{hex}'), string_split_regex(t, '{hex}') FROM texts),
each AS (
    SELECT doc_id, place, unnest(range(1, len(hits) + 1)) AS n, unnest(hits) AS hit, unnest(sized) AS sized,
           unnest(gaps[1:len(hits)]) AS gap FROM cut),
placed AS (
    SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, place ORDER BY n) AS stop FROM each),
kept AS (
    SELECT doc_id, place, kind, (stop - length(hit))::BIGINT AS start, stop::BIGINT AS stop
    FROM placed JOIN kinds USING (place) WHERE length(sized) >= least),
joined AS (
    SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
           count(*) FILTER (place = 2) AS n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (doc_id)
""".replace("{assign}", BASE_RULES[0].pattern.replace("'", "''")).replace("{access}", BASE_RULES[1].pattern).replace("{hex}", BASE_RULES[2].pattern)


@llm_query(_SECRETS_SQL)
def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "secret-ledger"))
    spans = F.coalesce("spans", F.array())
    text = F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_URL_SQL = """
WITH rules(host, path, verdict) AS (VALUES {rules}),
urls AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
best AS (
    SELECT u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM (SELECT DISTINCT host, path FROM urls) u JOIN rules r
      ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN best USING (host, path)
""".format(rules=", ".join(map(str, URL_RULES)))


@llm_query(_URL_SQL)
def op4_url_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@llm_query()
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bpe = ByteBpe(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    trip = table(spark, sf_dir, "documents").select("doc_id", bpe.round_trip("text").alias("trip"))
    return trip.select(
        "doc_id",
        F.size("trip.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("trip.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("trip.decoded", 256).alias("decoded_sha256"),
    )


@llm_query()
def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@llm_query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id") == 1
    model = fit_languages(docs.filter(~held_out))
    predicted = docs.select("doc_id", held_out.alias("held_out"), language(spark, model, "text").alias("found"))
    return predicted.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


@llm_query()
def op3_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    judged = docs.select("doc_id", quality.score(spark, model).alias("p"))
    return judged.select(
        "doc_id",
        F.col("p.content").alias("content_score"),
        F.col("p.metadata").alias("metadata_score"),
        "p.score",
        (F.col("p.score") >= quality.THRESHOLD).alias("keep"),
    )


@llm_query()
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passage of a document that matches a benchmark item; clean documents have none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    matched = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return matched.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


@llm_query()
def op10_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))

    def joined(spans: Column, kind) -> Column:
        return F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["stop"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = joined(F.col("spans"), lambda s: s["kind"])
    terms = joined(F.col("terms"), lambda s: F.lit(TERM))
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, terms), ",").alias("spans"),
        F.size("terms").cast("long").alias("n_terms"),
    )


NEIGHBOURS = 20


@llm_query()
def op1_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = posting_lists.build(vectors, NEIGHBOURS)
    asked = vectors.filter(F.col("vec_id") % 20 == 0).withColumnRenamed("vec_id", "query_id")
    return posting_lists.search(index, asked)


@llm_query()
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "stripped.n_bytes", "stripped.n_removed", "stripped.n_spans", F.sha2("stripped.kept", 256).alias("kept_sha256"))


# crc32 bit by bit, the least (cost, edits) from each state by recursion from the end, then the edits replayed
_REPAIR_SQL = r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
fated AS (
    SELECT conv_id, turn, role, text,
           xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
               lambda x, y: list_reduce(list_prepend(xor(x, y), range(8)),
                   lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)), 4294967295::BIGINT) % 20 AS fate
    FROM keyed),
hit AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
           CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS again
    FROM fated WHERE fate <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           rtrim(text, E' \t\n\x0b\f\r') AS told FROM hit),
faulty AS (
    SELECT conv_id, i, turn, role, text, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE '-' END AS t,
           CASE WHEN told = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                WHEN told[-1] NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS f FROM placed),
sized AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 1) AS blank,
           count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated FROM faulty GROUP BY conv_id),
met AS (
    SELECT conv_id, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT conv_id, lag(t) OVER (PARTITION BY conv_id ORDER BY i) || t AS pair FROM faulty) GROUP BY conv_id),
back AS (
    SELECT conv_id, n + 1 AS i, {'c': 0, 'a': ''} AS v0, {'c': 6, 'a': 'II'} AS v1, {'c': 3, 'a': 'I'} AS v2, {'c': 0, 'a': ''} AS v3 FROM sized
    UNION ALL
    SELECT conv_id, i, list_min([w0, {'c': 3 + w2.c, 'a': 'I' || w2.a}]), list_min([w1, {'c': 3 + w2.c, 'a': 'I' || w2.a}]),
           list_min([w2, {'c': 3 + w3.c, 'a': 'I' || w3.a}]), list_min([w3, {'c': 3 + w2.c, 'a': 'I' || w2.a}])
    FROM (
        SELECT conv_id, i, x0 AS w0, x1 AS w1, list_min([x2, {'c': 3 + x3.c, 'a': 'I' || x3.a}]) AS w2,
               list_min([x3, {'c': 3 + x2.c, 'a': 'I' || x2.a}]) AS w3
        FROM (
            SELECT r.conv_id, r.i,
                   list_min(list_filter([{'c': 4 + v0.c, 'a': 'D' || v0.a}, CASE WHEN f NOT IN (1, 2) THEN {'c': 3 + cut + v2.c, 'a': 'R' || v2.a} END,
                       CASE WHEN f NOT IN (1, 2) AND t = 's' THEN {'c': cut + v1.c, 'a': 'K' || v1.a} END,
                       CASE WHEN f NOT IN (1, 2) AND t = 'u' THEN {'c': cut + v2.c, 'a': 'K' || v2.a} END], lambda x: x IS NOT NULL)) AS x0,
                   list_min(list_filter([{'c': 4 + v1.c, 'a': 'D' || v1.a}, CASE WHEN f NOT IN (1, 2) THEN {'c': 3 + cut + v2.c, 'a': 'R' || v2.a} END,
                       CASE WHEN f NOT IN (1, 2) AND t = 'u' THEN {'c': cut + v2.c, 'a': 'K' || v2.a} END], lambda x: x IS NOT NULL)) AS x1,
                   list_min(list_filter([{'c': 4 + v2.c, 'a': 'D' || v2.a}, CASE WHEN f NOT IN (1, 2) THEN {'c': 3 + cut + v3.c, 'a': 'R' || v3.a} END,
                       CASE WHEN f NOT IN (1, 2) AND t = 'a' THEN {'c': cut + v3.c, 'a': 'K' || v3.a} END], lambda x: x IS NOT NULL)) AS x2,
                   list_min(list_filter([{'c': 4 + v3.c, 'a': 'D' || v3.a}, CASE WHEN f NOT IN (1, 2) THEN {'c': 3 + cut + v2.c, 'a': 'R' || v2.a} END,
                       CASE WHEN f NOT IN (1, 2) AND t = 'u' THEN {'c': cut + v2.c, 'a': 'K' || v2.a} END], lambda x: x IS NOT NULL)) AS x3
            FROM back b JOIN (SELECT *, CASE WHEN f = 3 THEN 3 ELSE 0 END AS cut FROM faulty) r
              ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i - 1))),
walk AS (
    SELECT conv_id, v0.a AS audit, v0.c AS cost, 1 AS step, 1::BIGINT AS i, 0 AS state, NULL::VARCHAR AS lines FROM back WHERE i = 1
    UNION ALL
    SELECT w.conv_id, audit, cost, step + 1, CASE WHEN audit[step] = 'I' THEN w.i ELSE w.i + 1 END,
           CASE audit[step] WHEN 'D' THEN state WHEN 'K' THEN CASE t WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
                ELSE CASE WHEN state = 2 THEN 3 ELSE 2 END END,
           CASE WHEN audit[step] = 'D' THEN lines
                ELSE coalesce(lines || E'
', '') || CASE WHEN audit[step] = 'K' THEN role WHEN state = 2 THEN 'assistant' ELSE 'user' END
                     || ':' || CASE WHEN audit[step] = 'I' THEN '' ELSE r.text END END
    FROM walk w LEFT JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i WHERE step <= length(audit)),
done AS (SELECT * FROM walk WHERE step = length(audit) + 1)
SELECT o.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate,
       coalesce(s.truncated, 0) AS truncated, coalesce(m.illegal, 0) AS illegal, coalesce(d.cost, 0)::BIGINT AS cost, coalesce(d.audit, '') AS audit,
       sha256(coalesce(d.lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN sized s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN met m ON m.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@llm_query(_REPAIR_SQL)
def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return report(repair(damaged(turns)), turns)


_NEGATIVES_SQL = """
WITH fine AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM fine a JOIN fine b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5
"""


@llm_query(_NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), hard_negatives.whole_numbers("embedding").alias("vector"))
    return hard_negatives.mine(*hard_negatives.build(rows))


_JACCARD_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s FROM words),
nodes AS (SELECT s, len(s) AS n, min(doc_id) AS node FROM sets WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT node, n, unnest(s) AS t FROM nodes),
shared AS (
    SELECT a.node AS a, b.node AS b, a.n + b.n - count(*) AS either, count(*) AS both_
    FROM tokens a JOIN tokens b ON a.t = b.t AND a.node < b.node AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
    GROUP BY a.node, b.node, a.n, b.n),
links AS (SELECT a, b FROM shared WHERE 100 * both_ >= 90 * either UNION SELECT b, a FROM shared WHERE 100 * both_ >= 90 * either),
reach AS (
    SELECT a AS node, a AS other FROM links
    UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(r.root, n.node, d.doc_id) AS component_id
FROM sets d LEFT JOIN nodes n ON n.s = d.s LEFT JOIN roots r ON r.node = n.node
"""


@llm_query(_JACCARD_SQL)
def op12_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
