"""Queries of the command chains, the worklists and the smaller operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.functions.vectors import centroids, hash_vector
from quillspark.operators import campaign, chunking, classify, conversion, dedup, detectors, filters, graph, hebrew, lint, repair, retrieval, translation, vault
from quillspark.plans.corpus_queries import _TOK
from quillspark.plans.quality_queries import _BROKEN, _CL, _DETECTED, _GLOSS, _HEB, _C, _chain, _gloss
from quillspark.plans.registry import register
from quillspark.plans.synth import DEFECTS_SQL, NOTES_SQL, defects, notes
from quillspark.plans.vault_queries import _DUP, _HEADS, _LINKS, _REACH, _STEMS


def _t(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- chains -------------------------------------------------------------------------------------------------------------

_CHUNK = f"""b AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), {_HEADS},
    w AS (SELECT doc_id, text, heads, least(length(heads), 160) AS room FROM b JOIN hd USING (doc_id)),
    p AS (SELECT doc_id, text, heads, room, substr(text, 1, 1600 - room) AS part, right(substr(text, 1, 1600 - room), 400) AS tail FROM w),
    c AS (SELECT *, greatest(CASE WHEN strpos(reverse(tail), ' .') > 0 THEN length(tail) - strpos(reverse(tail), ' .') - 1 ELSE -1 END, CASE WHEN strpos(reverse(tail), chr(10)) > 0 THEN length(tail) - strpos(reverse(tail), chr(10)) ELSE -1 END) AS cut FROM p),
    ch AS (SELECT doc_id, CASE WHEN length(text) > 1600 - room AND cut > 0 THEN substr(part, 1, length(part) - 400 + cut + 1) ELSE part END || CASE WHEN room > 0 THEN chr(10) || chr(10) || '## Outline' || chr(10) || substr(heads, 1, room) ELSE '' END AS text FROM c)"""
_RANKED = f"""t AS (SELECT doc_id, unnest({_TOK}[1:200]) AS w FROM ch), ln AS (SELECT doc_id, lang FROM documents),
    n AS (SELECT doc_id, CAST(('0x' || right(sha256(w), 2))::INT % 64 AS INT) AS b, CAST(count(*) AS DOUBLE) AS n FROM t GROUP BY ALL),
    v AS (SELECT doc_id, b, n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS x FROM n),
    k AS (SELECT lang, count(*) AS docs FROM documents GROUP BY lang),
    m AS (SELECT ln.lang, b, sum(x) / any_value(docs) AS x FROM v JOIN ln USING (doc_id) JOIN k USING (lang) GROUP BY ln.lang, b),
    ce AS (SELECT lang AS label, b, x / sqrt(sum(x * x) OVER (PARTITION BY lang)) AS x FROM m),
    s AS (SELECT v.doc_id, ce.label, sum(v.x * ce.x) AS score FROM v JOIN ce USING (b) GROUP BY ALL),
    a AS (SELECT d.doc_id, l.label, round(coalesce(s.score, 0), 6) AS score FROM documents d CROSS JOIN (SELECT DISTINCT label FROM ce) l LEFT JOIN s ON s.doc_id = d.doc_id AND s.label = l.label),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rank FROM a)"""


def _judge(judged):
    """A judge that trusts the first candidate by its lead over the second."""
    c = F.col("candidates")
    gap = F.round(F.get(c, 0)["score"] - F.get(c, 1)["score"], 6)
    bucket = F.when(gap >= 0.2, "SURE").when(gap >= 0.05, "NEEDS_HUMAN_VALIDATION").otherwise("I_GUESSED")
    reasoning = F.when(gap > 0, "the nearest centroid").otherwise("")  # a tie has no reason, so its verdict is rejected
    return F.to_json(F.struct(reasoning.alias("reasoning_brief"), F.get(c, 0)["label"].alias("primary_subdomain"), F.array().cast("array<string>").alias("secondary_subdomains"), F.lit("none").alias("relation_type"), bucket.alias("confidence_bucket")))


@register(
    "classify_chain",
    f"""WITH {_CHUNK}, {_RANKED}, g AS (SELECT doc_id, max(label) FILTER (WHERE rank = 1) AS pred, round(max(score) FILTER (WHERE rank = 1) - max(score) FILTER (WHERE rank = 2), 6) AS gap FROM r GROUP BY doc_id),
    j AS (SELECT d.lang AS truth, pred, CASE WHEN gap >= 0.2 THEN 'SURE' WHEN gap >= 0.05 THEN 'NEEDS_HUMAN_VALIDATION' ELSE 'I_GUESSED' END AS bucket FROM g JOIN documents d USING (doc_id) WHERE gap > 0)
    SELECT x.bucket, CAST(count(truth) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE truth = pred) AS BIGINT) AS correct, CASE WHEN count(truth) > 0 THEN round(count(*) FILTER (WHERE truth = pred) / count(truth), 4) END AS accuracy
    FROM (VALUES ('SURE'), ('NEEDS_HUMAN_VALIDATION'), ('I_GUESSED')) x(bucket) LEFT JOIN j USING (bucket) GROUP BY x.bucket""",
)
def classify_chain(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    chunk = lambda t: chunking.chunk(t, "first_window", 400)
    known = graph.cut_lineage(d.select("lang", hash_vector(chunk(F.col("text"))).alias("v")))
    taxonomy = sorted(r["lang"] for r in d.select("lang").distinct().collect())
    return classify.chain(d.select("doc_id", "text"), d.select("doc_id", F.col("lang").alias("truth")), taxonomy, chunk, hash_vector, _judge, centroids(known, "lang", "v").withColumnRenamed("lang", "label"), 2)["calibration"]


_FILES = "CASE doc_id % 9 WHEN 0 THEN 'raw/a/' || CAST(doc_id AS STRING) || '.txt' WHEN 1 THEN 'raw/' || CAST(doc_id AS STRING) || '.PDF' WHEN 2 THEN 'raw/b/' || CAST(doc_id AS STRING) || '.html' WHEN 3 THEN 'raw/n' || CAST(doc_id % 2 AS STRING) || '/s' || CAST(doc_id AS STRING) || '.one' WHEN 4 THEN 'raw/' || CAST(doc_id AS STRING) || '.bin' WHEN 5 THEN 'raw/n0/' || CAST(doc_id AS STRING) || '.onetoc2' WHEN 6 THEN 'raw/' || CAST(doc_id AS STRING) ELSE 'raw/' || CAST(doc_id AS STRING) || '.csv' END"


@register(
    "convert_run",
    f"""WITH f AS (SELECT doc_id, {_FILES} AS path, sha256(text) AS sha, regexp_extract(lower({_FILES}), '\\.([^./]+)$', 1) AS ext FROM documents),
    k AS (SELECT *, CASE WHEN ext = 'pdf' THEN 'docling' WHEN ext = 'html' THEN 'pandoc' WHEN ext IN ('txt', 'csv') THEN 'markitdown' WHEN ext IN ('one', 'onetoc2') THEN 'onenote' END AS conv, ext = 'one' AND starts_with(path, 'raw/n0/') AND (SELECT count(*) FROM f WHERE ext = 'onetoc2') > 0 AS inside FROM f),
    c AS (SELECT sha, min(path) AS first FROM k WHERE conv IS NOT NULL AND conv <> 'onenote' GROUP BY sha),
    j AS (SELECT k.*, CASE WHEN conv <> 'onenote' AND first <> path THEN first END AS dup FROM k LEFT JOIN c USING (sha)),
    s AS (SELECT *, CASE WHEN conv IS NULL THEN 'skipped' WHEN inside THEN 'skipped' WHEN dup IS NOT NULL THEN 'duplicate' WHEN doc_id % 7 = 0 THEN 'skipped' WHEN conv = 'pandoc' THEN 'failed' WHEN conv = 'docling' AND doc_id % 4 = 1 THEN 'failed' ELSE 'converted' END AS status FROM j)
    SELECT path, status, CASE WHEN conv IS NULL THEN 'unsupported extension ' || CASE WHEN ext = '' THEN '' ELSE '.' || ext END WHEN inside THEN 'part of notebook dir (handled via .onetoc2)' WHEN dup IS NOT NULL THEN NULL WHEN doc_id % 7 = 0 THEN 'up to date' WHEN conv = 'pandoc' THEN 'no converter' WHEN status = 'failed' THEN 'broken file' END AS reason,
    dup AS duplicate_of, CASE WHEN status = 'converted' THEN conv END AS converter, CASE WHEN status = 'converted' THEN sha END AS md_sha FROM s""",
)
def convert_run(spark, sf):
    d = _t(spark, sf, "documents").selectExpr("doc_id", f"{_FILES} AS path", "CAST(text AS BINARY) AS raw", "TIMESTAMP '2026-01-01 00:00:00' AS mtime")
    done = d.where("doc_id % 7 = 0").select(X.mirrored_path(F.col("path")).alias("path"), F.expr("TIMESTAMP '2026-01-02 00:00:00'").alias("mtime"))
    own = d.select("path", "doc_id")
    as_text = lambda raw: F.struct(raw.cast("string").alias("md"), F.lit(None).cast("string").alias("error"))
    number = F.regexp_extract("path", "(\\d+)\\.[^./]+$", 1).cast("int")
    scanned = lambda raw: F.struct(raw.cast("string").alias("md"), F.when(number % 4 == 1, "broken file").alias("error"))
    out = conversion.convert(d.select("path", "raw", "mtime"), done, {"markitdown": as_text, "docling": scanned, "onenote": as_text})
    return out.join(own, "path").select("path", "status", "reason", "duplicate_of", "converter", F.sha2(F.col("md").cast("binary"), 256).alias("md_sha"))


@register(
    "vault_check",
    f"""{_REACH}, {_LINKS}, {_STEMS}, f AS (
    SELECT count(*) AS n FROM links WHERE target NOT IN (SELECT stem FROM stems)
    UNION ALL SELECT count(*) FROM notes WHERE folder LIKE 'wiki%' AND stem NOT IN (SELECT target FROM links)
    UNION ALL SELECT count(*) FROM notes WHERE folder = 'raw' AND stem NOT IN (SELECT target FROM links)
    UNION ALL SELECT count(*) FROM notes WHERE folder = 'wiki' AND NOT contains(text, 'type: index') AND NOT contains(text, 'type: analysis') AND NOT contains(text, 'sources:')
    UNION ALL SELECT count(*) FROM notes WHERE folder = 'raw' AND NOT contains((SELECT text FROM notes WHERE stem = 'log'), stem)
    UNION ALL SELECT count(*) FROM notes WHERE folder LIKE 'wiki%' AND stem NOT IN (SELECT node FROM r)
    UNION ALL SELECT count(*) FROM ({_DUP})),
    t AS (SELECT count(*) AS todos FROM notes WHERE folder LIKE 'wiki%' AND contains(text, '<!-- TODO'))
    SELECT CAST((SELECT sum(n) FROM f) AS BIGINT) AS findings, CAST(todos AS BIGINT) AS todos, CAST((SELECT count(*) FROM stems) AS BIGINT) AS notes, true AS drift, 1 AS exit_status FROM t""",
)
def vault_check(spark, sf):
    return lint.check(notes(spark, sf), "1.0.0", "1.1.0")


@register("scaffold_plan", "SELECT 'p' || CAST(p_partkey AS VARCHAR) AS path, 'owned' AS tier FROM part WHERE p_size < 10 UNION ALL SELECT 'p' || CAST(p_partkey AS VARCHAR), 'scaffold_only' FROM part WHERE p_size >= 40")
def scaffold_plan(spark, sf):
    p = _t(spark, sf, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("path"), "p_size")
    return vault.scaffold(p.where("p_size < 10"), p.where("p_size >= 40"), spark.createDataFrame([], "path string"))


@register("vault_register", f"WITH {NOTES_SQL} SELECT CASE split_part(folder, '/', 1) WHEN 'raw' THEN 'sources' WHEN 'wiki' THEN 'concepts' ELSE 'indices' END AS collection, split_part(folder, '/', 1) AS folder, CAST(count(*) AS BIGINT) AS docs FROM notes GROUP BY ALL")
def vault_register(spark, sf):
    return vault.register_collections(notes(spark, sf))


_BM25 = f"""w AS (SELECT doc_id, {_TOK} AS w FROM documents), c AS (SELECT doc_id, len(w) AS dl, len([x FOR x IN w IF x = 'the']) AS a, len([x FOR x IN w IF x = 'und']) AS b FROM w),
    s AS (SELECT count(*) AS n, avg(dl) AS avgdl, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db FROM c),
    z AS (SELECT doc_id, round(ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / avgdl)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6) AS score FROM c, s WHERE a + b > 0)"""


@register("search_keywords", f"WITH {_BM25} SELECT doc_id, score FROM z ORDER BY score DESC, doc_id LIMIT 20")
def search_keywords(spark, sf):
    return retrieval.search(_t(spark, sf, "documents"), "doc_id", "text", ["the", "und"], 20)


@register("get_document", "SELECT doc_id, text, lang FROM documents WHERE doc_id = (SELECT min(doc_id) FROM labels)")
def get_document(spark, sf):
    first = _t(spark, sf, "labels").agg(F.min("doc_id")).first()[0]
    return retrieval.get(_t(spark, sf, "documents"), "doc_id", first).select("doc_id", "text", "lang")


@register("chunk_full", "SELECT doc_id, sha256(coalesce(text, '')) AS sha FROM documents")
def chunk_full(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.sha2(chunking.chunk(F.coalesce("text", F.lit("")), "full", 400).cast("binary"), 256).alias("sha"))


# --- Hebrew and glossaries ----------------------------------------------------------------------------------------------


@register(
    "heb_two_passes",
    f"""WITH d AS (SELECT regexp_extract_all({_HEB}, '[\\x{{0590}}-\\x{{05FF}}]+') AS t, doc_id % 3 = 0 AS ocr FROM documents), t AS (SELECT unnest(t) AS w FROM d WHERE NOT ocr), f AS (SELECT w, count(*) / (SELECT count(*) FROM t) AS f FROM t GROUP BY w), x AS (SELECT DISTINCT unnest(t) AS word FROM d WHERE ocr),
    j AS (SELECT word, contains('םןךףץ', word[1]) AS fin, coalesce(a.f, 0) AS cur, coalesce(b.f, 0) AS rev FROM x LEFT JOIN f a ON a.w = word LEFT JOIN f b ON b.w = reverse(word)),
    e AS (SELECT word, rev, CASE WHEN fin THEN 0 ELSE cur END AS own FROM j),
    g AS (SELECT word, CASE WHEN length(word) < 2 OR rev < 1e-5 OR rev <= own THEN 'keep' WHEN own = 0 OR rev >= 2 * own THEN 'fix' ELSE 'ambiguous' END AS decision FROM e)
    SELECT word, decision, CASE WHEN decision = 'fix' THEN reverse(word) ELSE word END AS fixed FROM g""",
)
def heb_two_passes(spark, sf):
    d = _t(spark, sf, "documents").selectExpr(f"{_HEB} AS h", "doc_id % 3 = 0 AS ocr")
    return hebrew.two_passes(d, "h", "ocr")


_TERMS = "SELECT DISTINCT array_to_string(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')[1:2], ' ') AS term, 'item ' || CAST(min(item_id) AS VARCHAR) AS english FROM benchmark GROUP BY 1"


@register("glossary_in_chunk", f"WITH g AS ({_TERMS}), d AS (SELECT doc_id, ' ' || array_to_string({_TOK}, ' ') || ' ' AS t FROM documents) SELECT doc_id, term, english FROM d JOIN g ON term <> '' AND contains(t, ' ' || term || ' ')")
def glossary_in_chunk(spark, sf):
    g = _t(spark, sf, "benchmark").groupBy(F.array_join(F.slice(X.tokens(F.col("text")), 1, 2), " ").alias("term")).agg(F.concat(F.lit("item "), F.min("item_id").cast("string")).alias("english"))
    return translation.in_chunk(_t(spark, sf, "documents"), g, "doc_id", "text")


@register("glossary_retention", f"WITH {_GLOSS}, g2 AS (SELECT term, min(english) AS english FROM g GROUP BY term), p AS (SELECT p_partkey AS doc_id, 'the part ' || p_type || ' and part ' || p_type || ' of ' || p_name AS source, 'a ' || p_brand || CAST(p_size % 4 AS VARCHAR) AS target FROM part) SELECT doc_id, term, CAST((length(source) - length(replace(source, term, ''))) // length(term) AS BIGINT) AS wanted, CAST((length(target) - length(replace(target, english, ''))) // length(english) AS BIGINT) AS found FROM p JOIN g2 ON contains(source, term)")
def glossary_retention(spark, sf):
    g = _gloss(spark, sf).groupBy("term").agg(F.min("english").alias("english"))
    p = _t(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), F.concat(F.lit("the part "), "p_type", F.lit(" and part "), "p_type", F.lit(" of "), "p_name").alias("source"), F.concat(F.lit("a "), "p_brand", (F.col("p_size") % 4).cast("string")).alias("target"))
    return translation.retention(p, g)


@register("forbidden_terms", "SELECT doc_id, array_to_string([t FOR t IN ['Verboten ', 'the ', ' und ', 'XQ'] IF contains(lower(text), lower(t))], ',') AS terms FROM documents WHERE len([t FOR t IN ['Verboten ', 'the ', ' und ', 'XQ'] IF contains(lower(text), lower(t))]) > 0")
def forbidden_terms(spark, sf):
    return translation.forbidden(_t(spark, sf, "documents"), "text", ["Verboten ", "the ", " und ", "XQ"]).select("doc_id", F.array_join("terms", ",").alias("terms"))


@register("question_queue", "SELECT lang AS campaign, source AS term, CAST(count(*) AS BIGINT) AS freq, CAST(count(DISTINCT doc_id) AS BIGINT) AS blocked_docs FROM documents GROUP BY ALL")
def question_queue(spark, sf):
    return translation.question_queue(_t(spark, sf, "documents").select(F.col("lang").alias("campaign"), F.col("source").alias("term"), "doc_id"))


# --- filters, worklists, repairs ----------------------------------------------------------------------------------------


@register("filter_registry", "SELECT * FROM (VALUES " + ", ".join(f"('{f.name}', '{f.lane}', {f.version}, {i})" for i, f in enumerate(filters.FILTERS.values())) + ") t(filter, lane, version, ord)")
def filter_registry(spark, sf):
    return filters.registry_table(spark)



@register("filt_rtl_corruption", f"SELECT a.doc_id, a.reversed_share, CASE WHEN lines_total > 0 THEN round(lines_flagged / lines_total, 4) ELSE 0.0 END AS flagged_share, greatest(a.reversed_share, CASE WHEN lines_total > 0 THEN round(lines_flagged / lines_total, 4) ELSE 0.0 END) AS rtl_corruption FROM ({_DETECTED['rtl_char_reversed']}) a JOIN ({_DETECTED['rtl_order_reversed']}) b USING (doc_id)")
def filt_rtl_corruption(spark, sf):
    return filters.rtl_corruption(detectors.run(defects(spark, sf), ["rtl_char_reversed", "rtl_order_reversed"]))


@register("worklist_resplit", f"WITH w AS (SELECT doc_id, 'split_no_title' AS d FROM ({_DETECTED['split_no_title']}) WHERE fired UNION ALL SELECT doc_id, 'split_opens_midsentence' FROM ({_DETECTED['split_opens_midsentence']}) WHERE fired) SELECT doc_id, string_agg(d, ',' ORDER BY d) AS detectors FROM w GROUP BY doc_id")
def worklist_resplit(spark, sf):
    return repair.worklist(detectors.run(defects(spark, sf)), "resplit").select("doc_id", F.array_join("detectors", ",").alias("detectors"))


_KIND = "CASE WHEN starts_with(h, '52494646') AND substr(h, 17, 8) = '57415645' THEN 'wav' " + " ".join(f"WHEN starts_with(h, '{sig}') THEN '{name}'" for sig, name in detectors.MAGIC) + " END"


@register("repair_reroute", f"WITH {DEFECTS_SQL}, x AS (SELECT doc_id, hex(raw) AS h FROM docs), k AS (SELECT doc_id, h, {_KIND} AS type FROM x) SELECT doc_id, type, CASE WHEN type = 'zip' AND contains(substr(h, 1, 8192), hex(encode('[Content_Types].xml'))) THEN 'recover_office' WHEN type IN ('zip', 'rar', '7z', 'gzip') THEN 'unpack' ELSE 'convert' END AS action FROM k WHERE type IS NOT NULL")
def repair_reroute(spark, sf):
    return repair.reroute_manifest(defects(spark, sf))


@register("repair_next_engine", "WITH t AS (SELECT user_id AS doc_id, bool_or(event_id % 3 = 0) AS a, bool_or(event_id % 3 = 1) AS b FROM events GROUP BY 1) SELECT doc_id, CASE WHEN NOT a THEN 'first' WHEN NOT b THEN 'second' END AS engine, a AND b AS poisoned FROM t")
def repair_next_engine(spark, sf):
    e = _t(spark, sf, "events").select(F.col("user_id").alias("doc_id"), F.when(F.col("event_id") % 3 == 0, "first").when(F.col("event_id") % 3 == 1, "second").otherwise("other").alias("engine"))
    return repair.next_engine(e, ["first", "second"])


@register("repair_reverse_words", "SELECT conv_id, turn, array_to_string(list_reverse(string_split(text, ' ')), ' ') AS text FROM conversations")
def repair_reverse_words(spark, sf):
    return _t(spark, sf, "conversations").select("conv_id", "turn", repair.reverse_words(F.col("text")).alias("text"))


@register("filt_false_rejects", "SELECT event_type AS filter_id, CAST(count(*) AS BIGINT) AS audited, round(avg((event_id % 5 = 0)::INT), 4) AS false_reject_rate FROM events GROUP BY 1")
def filt_false_rejects(spark, sf):
    return filters.false_reject_rate(_t(spark, sf, "events").select(F.col("event_type").alias("filter_id"), (F.col("event_id") % 5 == 0).alias("wrong")))


# --- classification, campaigns, graphs, small functions -----------------------------------------------------------------


@register("gold_join", "SELECT l.doc_id, CAST(l.quality AS VARCHAR) AS truth, CASE WHEN d.doc_id IS NOT NULL THEN d.lang WHEN l.toxic = 1 THEN 'own' END AS pred, CASE WHEN d.doc_id IS NOT NULL THEN 'SURE' ELSE 'I_GUESSED' END AS bucket FROM labels l LEFT JOIN (SELECT * FROM documents WHERE doc_id % 2 = 0) d USING (doc_id) WHERE d.doc_id IS NOT NULL OR l.toxic = 1")
def gold_join(spark, sf):
    gold = _t(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("truth"), F.when(F.col("toxic") == 1, "own").alias("pred"))
    found = _t(spark, sf, "documents").where("doc_id % 2 = 0").select("doc_id", F.col("lang").alias("pred"), F.lit("SURE").alias("bucket"))
    return classify.gold_join(gold, found)


@register("campaign_boosted", "SELECT doc_id, array_to_string(list_sort(list_distinct([x FOR x IN [CASE WHEN contains(lower(text), 'the ') THEN 'english' END, CASE WHEN contains(lower(text), ' und ') THEN 'german' END, CASE WHEN contains(lower(text), 'tion') THEN 'english' END] IF x IS NOT NULL])), ',') AS subdomains FROM documents")
def campaign_boosted(spark, sf):
    return campaign.boosted(_t(spark, sf, "documents"), "text", [("The ", "english"), (" und ", "german"), ("tion", "english")]).select("doc_id", F.array_join("subdomains", ",").alias("subdomains"))


@register("campaign_unassigned", "SELECT round(avg((toxic IS NULL)::INT), 4) AS unassigned FROM documents LEFT JOIN labels USING (doc_id)")
def campaign_unassigned(spark, sf):
    return campaign.unassigned_share(_t(spark, sf, "documents").select("doc_id").join(_t(spark, sf, "labels"), "doc_id", "left"), "toxic")


@register("graph_bridges", f"WITH {_C} SELECT src, dst, src % 4 AS src_label, dst % 4 AS dst_label FROM e WHERE src % 4 <> dst % 4")
def graph_bridges(spark, sf):
    e = _chain(spark, sf)
    labels = e.select(F.explode(F.array("src", "dst")).alias("node")).distinct().withColumn("label", F.col("node") % 4)
    return graph.bridges(e, labels)


@register("graph_hyperedges", "SELECT conv_id AS id, 'turns' AS relation, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS pos, turn AS node FROM conversations")
def graph_hyperedges(spark, sf):
    h = _t(spark, sf, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.lit("turns").alias("relation"), F.array_sort(F.collect_list("turn")).alias("nodes"))
    return graph.hyperedge_members(h).select("id", "relation", F.col("pos").cast("long").alias("pos"), "node")


@register("graph_changed", "SELECT 'd' || CAST(doc_id AS VARCHAR) AS path, sha256(text) AS sha FROM documents WHERE doc_id % 3 = 0 OR doc_id % 5 = 0")
def graph_changed(spark, sf):
    now = _t(spark, sf, "documents").select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("path"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    before = now.where("doc_id % 5 <> 0").withColumn("sha", F.when(F.col("doc_id") % 3 == 0, "old").otherwise(F.col("sha")))
    return graph.changed(now.select("path", "sha"), before.select("path", "sha"))


@register("attachment_duplicates", "SELECT CAST(doc_id AS VARCHAR) AS path, sha256(text) AS sha, doc_id AS ord, CASE WHEN doc_id > min(doc_id) OVER w THEN CAST(min(doc_id) OVER w AS VARCHAR) END AS duplicate_of FROM documents WINDOW w AS (PARTITION BY sha256(text))")
def attachment_duplicates(spark, sf):
    return dedup.attachment_duplicates(_t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("path"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.col("doc_id").alias("ord")))


@register("registry_drift", "SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN 'left' ELSE 'right' END AS side FROM part WHERE (p_partkey % 2 = 0) <> (p_partkey % 3 = 0)")
def registry_drift(spark, sf):
    p = _t(spark, sf, "part").select(F.col("p_partkey").alias("k"))
    return dedup.symmetric_difference(p.where("k % 2 = 0"), p.where("k % 3 = 0"), "k")


@register("new_notes", f"WITH {NOTES_SQL}, w AS (SELECT DISTINCT source || ' note' AS title FROM documents UNION SELECT 'Doc 0'), s AS (SELECT title, trim(regexp_replace(lower(trim(title)), '[^a-z0-9]+', '-', 'g'), '-') AS stem FROM w) SELECT stem FROM s WHERE stem NOT IN (SELECT stem FROM notes) GROUP BY stem")
def new_notes(spark, sf):
    w = _t(spark, sf, "documents").select(F.concat("source", F.lit(" note")).alias("title")).distinct().union(spark.createDataFrame([("Doc 0",)], "title string"))
    return vault.new_notes(w, notes(spark, sf)).select("stem")


@register("small_functions", "SELECT event_id, make_timestamp(2020 + CAST(event_id % 5 AS INT), 1 + CAST(event_id % 12 AS INT), 3, 4, 5, 6.0) AS pdf, 'dot-' || event_type || '/x' AS payload, event_type || chr(10) || props AS embedded, CASE WHEN event_id % 2 = 0 THEN '7.' || CAST(event_id AS VARCHAR) ELSE '1' END AS version FROM events")
def small_functions(spark, sf):
    e = _t(spark, sf, "events")
    stamp = F.concat(F.lit("D:"), (2020 + F.col("event_id") % 5).cast("string"), F.lpad((1 + F.col("event_id") % 12).cast("string"), 2, "0"), F.lit("03040506Z"))
    meta = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("x: 1\nversion: 7."), F.col("event_id").cast("string"), F.lit("\ny: 2"))).otherwise("x: version: 3")
    return e.select("event_id", X.pdf_date(stamp).alias("pdf"), X.payload_path(F.concat(F.lit("."), "event_type", F.lit("/x"))).alias("payload"), X.embed_text(F.col("event_type"), F.col("props")).alias("embedded"), X.file_version(meta).alias("version"))
