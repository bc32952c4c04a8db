"""Queries over documents, vectors, events, labels and pages: retrieval, dedup, ledgers, classification, calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.functions.vectors import centroids, hash_vector
from quillspark.operators import classify, dedup, filters, grading, ledger, retrieval
from quillspark.operators.detectors import length_percentiles
from quillspark.operators.graph import cut_lineage
from quillspark.plans.registry import register


def _t(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


_TOK = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')"


@register(
    "retr_hash_embed_topk",
    f"""WITH t AS (SELECT doc_id, lang, unnest({_TOK}[1:200]) AS w FROM documents),
    c AS (SELECT doc_id, lang, CAST(('0x' || right(sha256(w), 2))::INT % 64 AS INT) AS b, CAST(count(*) AS DOUBLE) AS n FROM t GROUP BY ALL),
    v AS (SELECT doc_id, lang, b, n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS x FROM c),
    k AS (SELECT lang, count(*) AS docs FROM documents GROUP BY lang),
    m AS (SELECT v.lang, b, sum(x) / any_value(docs) AS x FROM v JOIN k USING (lang) GROUP BY v.lang, b),
    ce AS (SELECT lang AS label, b, x / sqrt(sum(x * x) OVER (PARTITION BY lang)) AS x FROM m),
    s AS (SELECT v.doc_id, ce.label, sum(v.x * ce.x) AS score FROM v JOIN ce USING (b) GROUP BY ALL),
    a AS (SELECT d.doc_id, l.label, round(coalesce(s.score, 0), 6) AS score FROM documents d CROSS JOIN (SELECT DISTINCT label FROM ce) l LEFT JOIN s ON s.doc_id = d.doc_id AND s.label = l.label),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rank FROM a)
    SELECT doc_id, CAST(rank AS BIGINT) AS rank, label, score FROM r WHERE rank <= 2""",
)
def retr_hash_embed_topk(spark, sf):
    docs = cut_lineage(_t(spark, sf, "documents").select("doc_id", "lang", hash_vector(F.col("text")).alias("v")))
    return classify.top_candidates(docs, centroids(docs, "lang", "v"), "doc_id", "v", "lang", classify_top_k(2))


def classify_top_k(k: int) -> int:
    from quillspark.operators.chunking import clamp_top_k

    return clamp_top_k(k)


@register(
    "retr_embedding_centroid_topk",
    """WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings),
    m AS (SELECT label, p, avg(x) AS x FROM e GROUP BY ALL), c AS (SELECT label, p, x / sqrt(sum(x * x) OVER (PARTITION BY label)) AS x FROM m),
    s AS (SELECT e.vec_id, c.label, round(sum(e.x * c.x) / sqrt(sum(e.x * e.x)), 6) AS score FROM e JOIN c USING (p) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS rank FROM s)
    SELECT vec_id, CAST(rank AS BIGINT) AS rank, label, score FROM r WHERE rank <= 3""",
)
def retr_embedding_centroid_topk(spark, sf):
    e = _t(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return classify.top_candidates(e, centroids(e, "label", "v"), "vec_id", "v", "label", 3)


@register(
    "retr_embedding_knn",
    """WITH e AS (SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings),
    s AS (SELECT q.vec_id AS query, e.vec_id AS neighbour, round(list_cosine_similarity(q.v, e.v), 6) AS score FROM e q JOIN e ON q.vec_id % 50 = 0 AND q.vec_id <> e.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, neighbour) AS rank FROM s)
    SELECT query, CAST(rank AS BIGINT) AS rank, neighbour, score FROM r WHERE rank <= 5""",
)
def retr_embedding_knn(spark, sf):
    return retrieval.knn_self(_t(spark, sf, "embeddings"), "vec_id", "embedding", F.col("k") % 50 == 0, 5)


@register("retr_disagreement", """WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings),
    m AS (SELECT label, p, avg(x) AS x FROM e GROUP BY ALL), c AS (SELECT label, p, x / sqrt(sum(x * x) OVER (PARTITION BY label)) AS x FROM m),
    s AS (SELECT e.vec_id, c.label, round(sum(e.x * c.x) / sqrt(sum(e.x * e.x)), 6) AS score FROM e JOIN c USING (p) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS rank FROM s)
    SELECT vec_id, round(max(score) - min(score), 6) AS gap FROM r WHERE rank <= 2 GROUP BY vec_id HAVING count(*) = 2 AND round(max(score) - min(score), 6) <= 0.10""")
def retr_disagreement(spark, sf):
    e = _t(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return classify.disagreement(classify.top_candidates(e, centroids(e, "label", "v"), "vec_id", "v", "label", 2), "vec_id")


_CANON = "WITH k AS (SELECT 'docs/' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS path, sha256(text) AS sha FROM documents), c AS (SELECT path, sha, min(path) OVER (PARTITION BY sha) AS canonical, count(*) OVER (PARTITION BY sha) AS copies FROM k)"


def _canonical(spark, sf):
    d = _t(spark, sf, "documents").select(F.concat(F.lit("docs/"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("path"), "text")
    return dedup.canonical(d, "path", "text")


@register("dedup_exact_canonical", f"{_CANON} SELECT path, sha, canonical, CAST(copies AS BIGINT) AS copies, CASE WHEN path <> canonical THEN canonical END AS duplicate_of FROM c")
def dedup_exact_canonical(spark, sf):
    return _canonical(spark, sf)


@register("dedup_report_status_counts", f"{_CANON} SELECT CASE WHEN path <> canonical THEN 'duplicate' ELSE 'converted' END AS status, CAST(count(*) AS BIGINT) AS n FROM c GROUP BY 1")
def dedup_report_status_counts(spark, sf):
    from quillspark.operators.conversion import report

    return report(_canonical(spark, sf).withColumn("status", F.when(F.col("duplicate_of").isNotNull(), "duplicate").otherwise("converted")))


@register(
    "dedup_near_shingle",
    f"""WITH w AS (SELECT doc_id AS k, n_chars AS z, {_TOK} AS w FROM documents),
    g AS (SELECT k, z, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] ELSE [array_to_string(w, ' ')] END)) AS g FROM w WHERE len(w) > 0),
    best AS (SELECT g, arg_min(k, (-z, k)) AS k, min((-z, k)) AS o FROM g GROUP BY g),
    copies AS (SELECT g.k AS loser, best.k AS winner, 1.0::DOUBLE AS similarity FROM g JOIN best USING (g) WHERE g.k <> best.k),
    e AS (SELECT k, o, len(g) AS n, unnest(g) AS s FROM best),
    p AS (SELECT a.k AS ka, b.k AS kb, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM e a JOIN e b ON a.s = b.s AND a.o < b.o GROUP BY ALL)
    SELECT kb AS loser, ka AS winner, c / (na + nb - c) AS similarity FROM (SELECT ka, kb, CAST(na AS DOUBLE) AS na, nb, c FROM p) WHERE c / (na + nb - c) >= 0.9 UNION ALL SELECT * FROM copies""",
)
def dedup_near_shingle(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", X.tokens(F.col("text")).alias("w"), F.lit(1).alias("v"), "n_chars")
    return dedup.near_pairs(d, "doc_id", "w", "v", "n_chars")


@register("corpus_percentiles", """WITH s AS (SELECT strlen(text) AS z, row_number() OVER (ORDER BY strlen(text)) - 1 AS r, count(*) OVER () AS n FROM documents)
    SELECT CAST(max(z) FILTER (WHERE r = round_even(0.05 * (n - 1), 0)) AS BIGINT) AS p05, CAST(max(z) FILTER (WHERE r = round_even(0.5 * (n - 1), 0)) AS BIGINT) AS p50, CAST(max(z) FILTER (WHERE r = round_even(0.95 * (n - 1), 0)) AS BIGINT) AS p95 FROM s""")
def corpus_percentiles(spark, sf):
    p = length_percentiles(_t(spark, sf, "documents").select(F.col("text").cast("binary").alias("raw")))
    return spark.range(1).select(*[F.lit(p[k]).cast("long").alias(k) for k in ("p05", "p50", "p95")])


@register("bm25_topk", f"""WITH w AS (SELECT doc_id, {_TOK} AS w FROM documents), c AS (SELECT doc_id, len(w) AS dl, len([x FOR x IN w IF x = 'the']) AS a, len([x FOR x IN w IF x = 'und']) AS b, len([x FOR x IN w IF x = 'que']) AS c FROM w),
    s AS (SELECT count(*) AS n, avg(dl) AS avgdl, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db, count(*) FILTER (WHERE c > 0) AS dc FROM c)
    SELECT doc_id, round(ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / avgdl)) + ln(1 + (n - dc + 0.5) / (dc + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * dl / avgdl)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score
    FROM c, s WHERE a + b + c > 0""")
def bm25_topk(spark, sf):
    return retrieval.bm25(_t(spark, sf, "documents"), "doc_id", "text", ["the", "und", "que"])


@register("hybrid_rrf", """WITH e AS (SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings), q AS (SELECT v FROM e WHERE vec_id = 0), q2 AS (SELECT v FROM e WHERE vec_id = 1),
    a AS (SELECT vec_id, row_number() OVER (ORDER BY round(list_cosine_similarity(e.v, q.v), 6) DESC, vec_id) AS r FROM e, q), b AS (SELECT vec_id, row_number() OVER (ORDER BY round(list_cosine_similarity(e.v, q2.v), 6) DESC, vec_id) AS r FROM e, q2)
    SELECT vec_id, round(sum(1.0::DOUBLE / (60 + r)), 6) AS score FROM (SELECT * FROM a WHERE r <= 50 UNION ALL SELECT * FROM b WHERE r <= 50) GROUP BY vec_id ORDER BY score DESC, vec_id LIMIT 20""")
def hybrid_rrf(spark, sf):
    e = _t(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    qs = [list(r["v"]) for r in e.where("vec_id IN (0, 1)").orderBy("vec_id").collect()]
    return retrieval.fuse([retrieval.vector_search(e, "vec_id", "v", q, 50) for q in qs], "vec_id", 20)


_EVENT = "event_id, user_id, event_type, value"


@register("ledger_projection", "SELECT coalesce(CAST(user_id AS VARCHAR), '_global') AS key, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1")
def ledger_projection(spark, sf):
    return ledger.project(_t(spark, sf, "events").selectExpr(*_EVENT.split(", ")), "user_id", "event_id")


@register("ledger_dedup_keys", "SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL")
def ledger_dedup_keys(spark, sf):
    return ledger.first_by_key(_t(spark, sf, "events").selectExpr(*_EVENT.split(", ")), ["user_id", "event_type"], "event_id")


@register("ledger_stale_versions", "SELECT CAST(user_id AS VARCHAR) AS key, arg_max(v, event_id) AS v FROM (SELECT user_id, event_id, CAST(event_id % 3 AS VARCHAR) AS v FROM events) GROUP BY user_id HAVING arg_max(v, event_id) <> '2'")
def ledger_stale_versions(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "event_id", (F.col("event_id") % 3).cast("string").alias("v"))
    return ledger.stale(e, "user_id", "event_id", "v", F.lit("2")).select("key", "v")


@register("ledger_poison", "SELECT CAST(user_id AS VARCHAR) AS key FROM events GROUP BY user_id HAVING arg_max(event_id % 4, event_id) = 0")
def ledger_poison(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "event_id", F.when(F.col("event_id") % 4 == 0, "in_flight").otherwise("done").alias("status"))
    return ledger.poisoned(e, "user_id", "event_id", "status").select("key")


@register("ledger_new_rows", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def ledger_new_rows(spark, sf):
    return ledger.not_ledgered(_t(spark, sf, "documents").select("doc_id"), _t(spark, sf, "labels"), ["doc_id"])


@register("autonomy_streak", "WITH l AS (SELECT user_id, max(CASE WHEN event_id % 17 = 0 THEN event_id END) AS r FROM events GROUP BY 1) SELECT user_id, CAST(count(*) FILTER (WHERE r IS NULL OR event_id > r) AS BIGINT) AS streak, count(*) FILTER (WHERE r IS NULL OR event_id > r) >= 5 AS eligible FROM events JOIN l USING (user_id) GROUP BY user_id")
def autonomy_streak(spark, sf):
    return ledger.streaks(_t(spark, sf, "events").select("user_id", "event_id"), "user_id", "event_id", F.col("event_id") % 17 == 0, 5)


#: A verdict per document, every reason to reject one among them.
_JSON = """CASE doc_id % 9 WHEN 0 THEN '{bad' WHEN 1 THEN '{"confidence": 0.73, "primary_subdomain": "en"}'
    WHEN 2 THEN '{"confidence_bucket": "MAYBE", "primary_subdomain": "en", "reasoning_brief": "r"}'
    WHEN 3 THEN '{"confidence_bucket": "SURE", "relation_type": "odd", "primary_subdomain": "en", "reasoning_brief": "r"}'
    WHEN 4 THEN '{"confidence_bucket": "SURE", "relation_type": "none", "primary_subdomain": "en", "reasoning_brief": "  "}'
    WHEN 5 THEN '{"confidence_bucket": "SURE", "primary_subdomain": "xx", "reasoning_brief": "r"}'
    WHEN 6 THEN '{"confidence_bucket": "SURE", "primary_subdomain": "en", "secondary_subdomains": ["de", "zz"], "reasoning_brief": "r"}'
    WHEN 7 THEN '{"confidence_bucket": "I_GUESSED", "primary_subdomain": "' || lang || '", "secondary_subdomains": ["de"], "relation_type": "comparison", "reasoning_brief": "r"}'
    ELSE '{"confidence_bucket": "NEEDS_HUMAN_VALIDATION", "primary_subdomain": "' || lang || '", "secondary_subdomains": [], "reasoning_brief": "ok"}' END"""
_REASON = "CASE doc_id % 9 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'numeric_confidence' WHEN 2 THEN 'bad_bucket' WHEN 3 THEN 'bad_relation' WHEN 4 THEN 'no_reasoning' WHEN 5 THEN 'bad_primary' WHEN 6 THEN 'bad_secondary' END"
TAXONOMY = ["en", "de", "fr", "es"]


@register("classify_validate", f"SELECT doc_id, {_REASON} AS reason FROM documents")
def classify_validate(spark, sf):
    return _t(spark, sf, "documents").selectExpr("doc_id", f"{_JSON} AS json").select("doc_id", classify.reject_reason(F.col("json"), TAXONOMY).alias("reason"))


@register(
    "classify_idempotent",
    f"""WITH v AS (SELECT doc_id, {_REASON} AS reason, CASE WHEN doc_id % 9 IN (7, 8) THEN lang WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 9 = 5 THEN 'xx' ELSE 'en' END AS "primary", doc_id % 9 = 7 AS guessed FROM documents),
    o AS (SELECT doc_id, coalesce(reason, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'skipped' ELSE 'classified' END) AS outcome, "primary", guessed FROM v)
    SELECT doc_id, outcome, "primary", CASE WHEN outcome = 'classified' THEN CASE WHEN guessed THEN 'low' ELSE 'needs_review' END END AS trust FROM o""",
)
def classify_idempotent(spark, sf):
    d = _t(spark, sf, "documents")
    verdicts = d.selectExpr("doc_id", f"{_JSON} AS json")
    seen = d.join(_t(spark, sf, "labels").select("doc_id"), "doc_id").select("doc_id", F.col("lang").alias("primary"))
    return classify.classify(verdicts, seen, TAXONOMY)


_GRADED = "g AS (SELECT doc_id, CAST(toxic AS VARCHAR) AS truth, CAST((doc_id % 7 = 0)::INT AS VARCHAR) AS pred, CASE doc_id % 4 WHEN 0 THEN 'SURE' WHEN 1 THEN 'I_GUESSED' ELSE 'SURE' END AS bucket FROM labels)"


def _graded(spark, sf):
    return _t(spark, sf, "labels").select("doc_id", F.col("toxic").cast("string").alias("truth"), (F.col("doc_id") % 7 == 0).cast("int").cast("string").alias("pred"), F.when(F.col("doc_id") % 4 == 1, "I_GUESSED").otherwise("SURE").alias("bucket"))


@register("calib_bucket_accuracy", f"WITH {_GRADED} SELECT b.bucket, CAST(count(doc_id) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE truth = pred) AS BIGINT) AS correct, CASE WHEN count(doc_id) > 0 THEN round(count(*) FILTER (WHERE truth = pred) / count(doc_id), 4) END AS accuracy FROM (VALUES ('SURE'), ('NEEDS_HUMAN_VALIDATION'), ('I_GUESSED')) b(bucket) LEFT JOIN g USING (bucket) GROUP BY b.bucket")
def calib_bucket_accuracy(spark, sf):
    return classify.bucket_accuracy(_graded(spark, sf))


@register("calib_confusion", f"WITH {_GRADED}, c AS (SELECT truth, pred, CAST(count(*) AS BIGINT) AS n FROM g GROUP BY ALL ORDER BY n DESC, truth, pred LIMIT 10) SELECT * FROM c WHERE truth <> pred")
def calib_confusion(spark, sf):
    return classify.confusion(_graded(spark, sf))


@register("calib_glossary_miss", f"WITH {_GRADED} SELECT round(avg((truth = pred)::INT), 4) AS accuracy, round(avg((truth = pred)::INT) FILTER (WHERE bucket = 'I_GUESSED'), 4) AS guessed_accuracy, coalesce(1 - avg((truth = pred)::INT) FILTER (WHERE bucket = 'I_GUESSED') > 0.5, false) AS glossary_miss FROM g")
def calib_glossary_miss(spark, sf):
    return classify.glossary_miss(_graded(spark, sf))


@register("review_stratified", "SELECT doc_id, source, CAST(pick AS BIGINT) AS pick FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS pick FROM documents) WHERE pick <= 8")
def review_stratified(spark, sf):
    return classify.stratified(_t(spark, sf, "documents").select("doc_id", "source"), "doc_id", "source")


@register("filt_hex_ratio", "SELECT doc_id, CASE WHEN length(text) > 0 THEN round(length(regexp_replace(text, '[^0-9A-Fa-f]', '', 'g')) / length(text), 4) ELSE 0.0 END AS hex_ratio, CASE WHEN length(text) > 0 THEN round(length(regexp_replace(text, '[^0-9]', '', 'g')) / length(text), 4) ELSE 0.0 END AS digit_share FROM documents")
def filt_hex_ratio(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select("doc_id", filters.char_share(F.col("text"), "0-9A-Fa-f").alias("hex_ratio"), filters.char_share(F.col("text"), "0-9").alias("digit_share"))


@register("filt_audit_sample", "SELECT doc_id FROM documents WHERE ('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 5")
def filt_audit_sample(spark, sf):
    return _t(spark, sf, "documents").where(filters.audited(F.col("doc_id"), 5)).select("doc_id")


@register("filt_whole_json", "SELECT event_id, coalesce(json_valid(props) AND regexp_matches(props, '^\\s*[\\[{]'), false) AS is_json FROM events")
def filt_whole_json(spark, sf):
    return _t(spark, sf, "events").select("event_id", filters.is_json(F.col("props")).alias("is_json"))


_GUID = "123e4567-e89b-12d3-a456-426614174000"
_SPANS = f"CASE doc_id % 6 WHEN 0 THEN '{_GUID} scan_' || CAST(doc_id AS STRING) || '.pdf' WHEN 1 THEN 'see {_GUID} ' || text WHEN 2 THEN '{_GUID}.pdf' WHEN 3 THEN 'a.txt-{_GUID} x_{_GUID}.v2.docx, ' || text ELSE text END"


# The twin goes through the runs of a file name's characters: in a run what goes up to its last ending is a name, the rest holds GUIDs.
@register("filt_guid_coverage", f"""WITH d AS (SELECT doc_id, {_SPANS} AS text FROM documents),
    r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\\w.-]+')) AS run FROM d),
    n AS (SELECT doc_id, run, regexp_extract(run, '^[\\w.-]+\\.(?:pdf|docx?|xlsx?|pptx?|png|jpe?g|gif|zip|txt|csv|html?)\\b') AS name FROM r),
    c AS (SELECT doc_id, sum(length(name) + 36 * len(regexp_extract_all(substr(run, length(name) + 1), '[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}'))) AS covered FROM n GROUP BY doc_id),
    s AS (SELECT doc_id, length(regexp_replace(text, '\\s', '', 'g')) AS dense FROM d)
    SELECT doc_id, CASE WHEN dense > 0 THEN round(coalesce(covered, 0) / dense, 4) ELSE 0 END AS coverage FROM s LEFT JOIN c USING (doc_id)""")
def filt_guid_coverage(spark, sf):
    return _t(spark, sf, "documents").selectExpr("doc_id", f"{_SPANS} AS text").select("doc_id", filters.span_coverage(F.col("text")).alias("coverage"))


@register("filt_routing", """WITH d AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) <> doc_id AS dup, CASE doc_id % 5 WHEN 0 THEN ' IN' WHEN 1 THEN 'out' ELSE 'hm' END AS v, doc_id % 13 = 0 AS prot FROM documents)
    SELECT doc_id, CASE WHEN prot THEN 'accept' WHEN dup THEN 'reject' WHEN lower(trim(v)) = 'in' THEN 'accept' WHEN v = 'out' THEN 'reject' ELSE 'expert' END AS route FROM d""")
def filt_routing(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text")
    firsts = d.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("sha")).agg(F.min("doc_id").alias("first"))
    j = d.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256)).join(firsts, "sha")
    v = filters.verdict(F.when(F.col("doc_id") % 5 == 0, " IN").when(F.col("doc_id") % 5 == 1, "out").otherwise("hm"))
    gated = F.when(F.col("first") != F.col("doc_id"), "exact_duplicate")
    return j.select("doc_id", filters.routing(gated, v, F.col("doc_id") % 13 == 0).alias("route"))


_LINES = "[l FOR l IN string_split_regex(text, '\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x{85}\\x{2028}\\x{2029}]') IF trim(l, ' ' || chr(9)) <> '']"


@register("filt_evidence", f"""WITH l AS (SELECT doc_id, text, length(text) AS n, {_LINES} AS ls FROM documents),
    m AS (SELECT *, len([x FOR x IN ls IF length(x) - length(replace(x, '|', '')) >= 2]) AS rows, len([x FOR x IN ls IF starts_with(ltrim(x, ' '), '#')]) AS heads, list_sum([length(x) FOR x IN regexp_extract_all(text, '\\p{{Lu}}[^.!?\\n]{{20,}}[.!?]')]) AS prose FROM l)
    SELECT doc_id, CASE WHEN n > 0 THEN round(length(regexp_replace(text, '[^0-9A-Fa-f]', '', 'g')) / n, 4) ELSE 0.0 END AS hex_char_ratio, CASE WHEN n > 0 THEN round(length(regexp_replace(text, '[^0-9]', '', 'g')) / n, 4) ELSE 0.0 END AS digit_share,
    CASE WHEN len(ls) > 0 THEN round(rows / len(ls), 4) ELSE 0.0 END AS table_row_share, CASE WHEN n > 0 THEN round(len(regexp_extract_all(text, '\\[[^\\]]*\\]\\(|https?://')) / n * 1000, 3) ELSE 0.0 END AS links_per_kchar,
    CASE WHEN len(ls) > 0 THEN round(heads / len(ls), 4) ELSE 0.0 END AS heading_share, CAST(len(regexp_extract_all(text, '\\{{[a-zA-Z][\\w-]*(?::[^}}]*)?\\}}|<ac:')) AS DOUBLE) AS macro_count,
    CASE WHEN n > 0 THEN round(len(regexp_extract_all(text, '\\x{{FFFD}}|Ã[\\x{{80}}-\\x{{BF}}]|â€')) / n * 1000, 3) ELSE 0.0 END AS mojibake_per_kchar, CAST(regexp_matches(substr(text, 1, 200), '(?i)\\b(archived?|deprecated|obsolete)\\b') AS INT)::DOUBLE AS archived,
    CASE WHEN n > 0 THEN round(coalesce(prose, 0) / n, 4) ELSE 0.0 END AS prose_density FROM m""")
def filt_evidence(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.col("text")).select("doc_id", *[c.alias(k) for k, c in filters.measures(F.col("text")).items()])


@register("filt_whole_xml")
def filt_whole_xml(spark, sf):
    return filters.with_xml_flag(_t(spark, sf, "pages").select("page_id", "html"), "html").select("page_id", "is_xml")


@register("eval_contamination", """WITH d AS (SELECT doc_id, ' ' || array_to_string([w FOR w IN string_split_regex(lower(text), '\\s+') IF w <> ''], ' ') || ' ' AS t FROM documents), b AS (SELECT item_id, [w FOR w IN string_split_regex(lower(text), '\\s+') IF w <> ''] AS ws FROM benchmark)
    SELECT doc_id, item_id FROM d JOIN b ON len(ws) >= 1 AND contains(d.t, ' ' || array_to_string(ws, ' ') || ' ')""")
def eval_contamination(spark, sf):
    return grading.contaminated(_t(spark, sf, "documents"), _t(spark, sf, "benchmark"))


_CASES = "c AS (SELECT doc_id AS case_id, CASE doc_id % 3 WHEN 0 THEN 'T1' WHEN 1 THEN 'T2' ELSE 'T3' END AS grp, text AS gold, ['doc-' || CAST(doc_id AS STRING), 'Doc-1', 'doc-2'] AS expected, CASE WHEN doc_id % 2 = 0 THEN text || ' [[doc-' || CAST(doc_id AS STRING) || ']] doc-1 ' ELSE 'This is not covered here. DOC-2 doc-1.md ' || source END AS answer FROM documents)"
_STOP = ", ".join(f"'{w}'" for w in X.STOPWORDS)
_MARK = " OR ".join("contains(lower(answer), '" + m.replace("'", "''") + "')" for m in X.REFUSALS)


@register(
    "eval_grade",
    f"""WITH {_CASES},
    m AS (SELECT case_id, grp, gold, answer, expected, [s FOR s IN expected IF NOT contains(lower(answer), lower(s))] AS missing, list_distinct([w FOR w IN regexp_extract_all(lower(gold), '[a-z0-9][a-z0-9\\-]*') IF length(w) > 2 AND NOT list_contains([{_STOP}], w)]) AS g, list_distinct(regexp_extract_all(lower(answer), '[a-z0-9][a-z0-9\\-]*')) AS a FROM c)
    SELECT case_id, CASE WHEN grp = 'T2' THEN {_MARK} ELSE len(missing) <= CASE WHEN grp = 'T3' AND len(expected) > 2 THEN 1 ELSE 0 END END AS passed,
    CASE WHEN len(g) = 0 THEN 0.0::DOUBLE ELSE round_even(100.0::DOUBLE * len(list_intersect(g, a)) / len(g), 0) END AS overlap, CASE WHEN grp = 'T2' THEN '' ELSE array_to_string(missing, ',') END AS missing FROM m""",
)
def eval_grade(spark, sf):
    d = _t(spark, sf, "documents").selectExpr(
        "doc_id AS case_id", "CASE doc_id % 3 WHEN 0 THEN 'T1' WHEN 1 THEN 'T2' ELSE 'T3' END AS grp", "text AS gold", "array('doc-' || CAST(doc_id AS STRING), 'Doc-1', 'doc-2') AS expected",
        "CASE WHEN doc_id % 2 = 0 THEN text || ' [[doc-' || CAST(doc_id AS STRING) || ']] doc-1 ' ELSE 'This is not covered here. DOC-2 doc-1.md ' || source END AS answer",
    )
    return grading.grade(d).select("case_id", "passed", "overlap", F.array_join("missing", ",").alias("missing"))
