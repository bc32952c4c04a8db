"""Queries over notes: parsing, links, lint, chunks, text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import markdown as M
from quillspark.functions import text as X
from quillspark.operators import chunking, lint
from quillspark.plans.registry import register
from quillspark.plans.synth import NOTES_SQL, content_lines_sql, notes

_LINKS = "links AS (SELECT stem, path, folder, unnest([trim(x) FOR x IN regexp_extract_all(text, '\\[\\[([^\\]|#]+)', 1)]) AS target FROM notes WHERE folder IN ('wiki', 'wiki/sources', 'index'))"
_STEMS = "stems AS (SELECT DISTINCT stem FROM notes WHERE folder IN ('raw', 'wiki', 'wiki/sources', 'index'))"
_W = f"WITH {NOTES_SQL}, {_LINKS}, {_STEMS}"


@register("lines_content_view", f"WITH {NOTES_SQL}, {content_lines_sql('notes', 'doc_id')} SELECT key AS doc_id, CAST(line_no AS BIGINT) AS line_no, line FROM cl")
def lines_content_view(spark, sf):
    return M.content_lines(notes(spark, sf), "doc_id").select("doc_id", F.col("line_no").cast("long"), "line")


@register(
    "fm_parse_scalars_lists",
    f"""WITH {NOTES_SQL},
    l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS n FROM notes WHERE starts_with(text, '---')),
    e AS (SELECT doc_id, min(n) AS shut FROM l WHERE n > 1 AND trim(line) = '---' GROUP BY doc_id),
    h AS (SELECT doc_id, line, n FROM l JOIN e USING (doc_id) WHERE n > 1 AND n < shut),
    k AS (SELECT doc_id, n, line, regexp_matches(line, '^\\s*-\\s+') AS item, max(CASE WHEN NOT regexp_matches(line, '^\\s*-\\s+') THEN n END) OVER (PARTITION BY doc_id ORDER BY n) AS owner FROM h),
    keys AS (SELECT doc_id, n AS owner, trim(regexp_extract(line, '^([^:\\s][^:]*):(.*)$', 1)) AS key, trim(regexp_extract(line, '^([^:\\s][^:]*):(.*)$', 2), ' ') AS value FROM k WHERE NOT item),
    items AS (SELECT doc_id, owner, string_agg(trim(trim(regexp_extract(line, '^\\s*-\\s+(.*)$', 1)), '"'), '|' ORDER BY n) AS vs FROM k WHERE item GROUP BY ALL)
    SELECT doc_id, key, CASE WHEN value <> '' THEN trim(value, '"') ELSE coalesce(vs, '') END AS value FROM keys LEFT JOIN items USING (doc_id, owner)""",
)
def fm_parse(spark, sf):
    return notes(spark, sf).select("doc_id", F.explode(M.frontmatter(F.col("text"))).alias("key", "v")).select("doc_id", "key", F.array_join("v", "|").alias("value"))


@register(
    "fm_body",
    f"""WITH {NOTES_SQL} SELECT doc_id, sha256(CASE WHEN starts_with(text, '---') THEN substr(text, strpos(text, chr(10) || '---' || chr(10)) + 5) ELSE text END) AS body_sha FROM notes""",
)
def fm_body(spark, sf):
    return notes(spark, sf).select("doc_id", F.sha2(M.body(F.col("text")).cast("binary"), 256).alias("body_sha"))


@register("links_extract", f"WITH {NOTES_SQL} SELECT doc_id, CAST(p AS BIGINT) AS pos, trim(ts[p + 1]) AS target FROM (SELECT doc_id, regexp_extract_all(text, '\\[\\[([^\\]|#]+)', 1) AS ts FROM notes), unnest(range(0, len(ts))) AS u(p)")
def links_extract(spark, sf):
    return notes(spark, sf).select("doc_id", F.posexplode(M.wikilinks(F.col("text"))).alias("pos", "target")).select("doc_id", F.col("pos").cast("long"), "target")


@register("links_broken", f"{_W} SELECT path, target FROM links WHERE target NOT IN (SELECT stem FROM stems)")
def links_broken(spark, sf):
    return lint.broken_links(notes(spark, sf)).select("path", "target")


@register("links_orphans", f"{_W} SELECT path, stem FROM notes WHERE folder LIKE 'wiki%' AND stem NOT IN (SELECT target FROM links)")
def links_orphans(spark, sf):
    return lint.orphans(notes(spark, sf))


@register("lint_unreferenced_raw", f"{_W} SELECT path, stem FROM notes WHERE folder = 'raw' AND stem NOT IN (SELECT target FROM links)")
def lint_unreferenced_raw(spark, sf):
    return lint.unreferenced_raw(notes(spark, sf))


@register("lint_missing_sources", f"{_W} SELECT path, stem FROM notes WHERE folder = 'wiki' AND NOT contains(text, 'type: index') AND NOT contains(text, 'type: analysis') AND NOT contains(text, 'sources:')")
def lint_missing_sources(spark, sf):
    return lint.missing_sources(notes(spark, sf))


@register("lint_todo", f"{_W} SELECT path, stem FROM notes WHERE folder LIKE 'wiki%' AND contains(text, '<!-- TODO')")
def lint_todo(spark, sf):
    return lint.todo_markers(notes(spark, sf))


@register("lint_log_coverage", f"{_W} SELECT path, stem FROM notes WHERE folder = 'raw' AND NOT contains((SELECT text FROM notes WHERE stem = 'log'), stem)")
def lint_log_coverage(spark, sf):
    return lint.missing_log_entries(notes(spark, sf))


_DUP = "SELECT stem, path, first_path FROM (SELECT stem, path, first_value(path) OVER w AS first_path, row_number() OVER w AS r FROM notes WHERE folder IN ('raw', 'wiki', 'wiki/sources', 'index') WINDOW w AS (PARTITION BY stem ORDER BY list_position(['raw', 'wiki', 'wiki/sources', 'index'], folder), path)) WHERE r > 1"


@register("lint_dup_stems", f"{_W} {_DUP}")
def lint_dup_stems(spark, sf):
    return lint.duplicate_stems(notes(spark, sf))


_REACH = f"""WITH RECURSIVE {NOTES_SQL},
    lastnote AS (SELECT stem, arg_max(text, (list_position(['raw', 'wiki', 'wiki/sources', 'index'], folder), path)) AS text FROM notes GROUP BY stem),
    e AS (SELECT DISTINCT stem AS src, unnest([trim(x) FOR x IN regexp_extract_all(text, '\\[\\[([^\\]|#]+)', 1)]) AS dst FROM lastnote),
    r(node) AS (SELECT '_map-of-content' UNION SELECT e.dst FROM r JOIN e ON e.src = r.node WHERE e.dst IN (SELECT stem FROM lastnote))"""


@register("links_reachable", f"{_REACH} SELECT path, stem FROM notes WHERE folder LIKE 'wiki%' AND stem NOT IN (SELECT node FROM r)")
def links_reachable(spark, sf):
    return lint.unreachable(notes(spark, sf))


@register(
    "lint_summary",
    f"""{_REACH}, {_LINKS}, {_STEMS}, f AS (
    SELECT 'broken_link' AS "check" FROM links WHERE target NOT IN (SELECT stem FROM stems)
    UNION ALL SELECT 'orphan' FROM notes WHERE folder LIKE 'wiki%' AND stem NOT IN (SELECT target FROM links)
    UNION ALL SELECT 'unreferenced_raw' FROM notes WHERE folder = 'raw' AND stem NOT IN (SELECT target FROM links)
    UNION ALL SELECT 'missing_sources' FROM notes WHERE folder = 'wiki' AND NOT contains(text, 'type: index') AND NOT contains(text, 'type: analysis') AND NOT contains(text, 'sources:')
    UNION ALL SELECT 'no_log_entry' FROM notes WHERE folder = 'raw' AND NOT contains((SELECT text FROM notes WHERE stem = 'log'), stem)
    UNION ALL SELECT 'unreachable' FROM notes WHERE folder LIKE 'wiki%' AND stem NOT IN (SELECT node FROM r)
    UNION ALL SELECT 'duplicate_stem' FROM ({_DUP})
    UNION ALL SELECT 'todo' FROM notes WHERE folder LIKE 'wiki%' AND contains(text, '<!-- TODO'))
    SELECT "check", CAST(count(*) AS BIGINT) AS n, CASE "check" WHEN 'broken_link' THEN 'repair_link' WHEN 'orphan' THEN 'add_inbound_link' WHEN 'unreferenced_raw' THEN 'ingest' WHEN 'missing_sources' THEN 'add_sources' WHEN 'no_log_entry' THEN 'append_log' WHEN 'unreachable' THEN 'link_from_map' ELSE 'report' END AS fix FROM f GROUP BY "check\"""",
)
def lint_summary(spark, sf):
    return lint.with_fix(lint.findings(notes(spark, sf))).groupBy("check", "fix").agg(F.count("*").alias("n")).select("check", "n", "fix")


@register(
    "status_matrix",
    f"""WITH {NOTES_SQL},
    s AS (SELECT DISTINCT regexp_extract(text, 'sources:\\n- "\\[\\[([^\\]]+)\\]\\]"', 1) AS stem FROM notes WHERE folder LIKE 'wiki%')
    SELECT stem, CASE WHEN stem IN (SELECT stem FROM s) THEN 'yes' ELSE 'NO' END AS summary, CASE WHEN contains((SELECT text FROM notes WHERE stem = 'registry'), stem) THEN 'yes' ELSE 'NO' END AS registry,
    CASE WHEN contains((SELECT text FROM notes WHERE stem = 'log'), stem) THEN 'yes' ELSE 'NO' END AS log FROM (SELECT DISTINCT stem FROM notes WHERE folder = 'raw')""",
)
def status_matrix(spark, sf):
    return lint.status(notes(spark, sf))


@register("slugify_titles", "SELECT doc_id, trim(regexp_replace(lower(trim(source || ' ' || text)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM documents")
def slugify_titles(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", X.slugify(F.concat_ws(" ", "source", "text")).alias("slug"))


@register("html_title", "SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM pages")
def html_title(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", X.html_title(F.col("html")).alias("title"))


@register(
    "html_to_text",
    """WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>|<nav\\b[^>]*>.*?</nav>|<!--.*?-->', ' ', 'g') AS x FROM pages),
    b AS (SELECT page_id, regexp_replace(x, '<[^>]*>', ' ', 'g') AS x FROM a),
    c AS (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS x FROM b)
    SELECT page_id, trim(regexp_replace(x, '\\s+', ' ', 'g')) AS text FROM c""",
)
def html_to_text(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", X.html_text(F.col("html")).alias("text"))


@register(
    "md_to_html",
    f"""WITH {NOTES_SQL},
    a AS (SELECT doc_id, replace(replace(replace(replace(replace(CASE WHEN starts_with(text, '---') THEN substr(text, strpos(text, chr(10) || '---' || chr(10)) + 5) ELSE text END, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS x FROM notes),
    b AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(x, '(?m)^### (.+)$', '<h3>\\1</h3>', 'g'), '(?m)^## (.+)$', '<h2>\\1</h2>', 'g'), '(?m)^# (.+)$', '<h1>\\1</h1>', 'g') AS x FROM a),
    c AS (SELECT doc_id, regexp_replace(regexp_replace(x, '\\*\\*(.+?)\\*\\*', '<strong>\\1</strong>', 'g'), '(?s)```(.*?)```', '<pre>\\1</pre>', 'g') AS x FROM b)
    SELECT doc_id, '<p>' || regexp_replace(x, '\\n\\n+', '</p><p>', 'g') || '</p>' AS html FROM c""",
)
def md_to_html(spark, sf):
    return notes(spark, sf).select("doc_id", X.markdown_html(M.body(F.col("text"))).alias("html"))


@register("chunk_store_path", "SELECT doc_id, 'store/' || substr(sha256(text), 1, 2) || '/' || sha256(text) || '.md' AS path, CAST(greatest(1, length(text) // 4) AS BIGINT) AS tokens FROM documents")
def chunk_store_path(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", X.store_path(F.col("text")).alias("path"), X.token_estimate(F.col("text")).cast("long").alias("tokens"))


_HEADS = """hd_s AS (SELECT doc_id, text, string_split_regex(text, '\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x{85}\\x{2028}\\x{2029}]') AS ls FROM b),
    hd_t AS (SELECT doc_id, text, CASE WHEN ls[-1] = '' THEN ls[:-2] ELSE ls END AS ls FROM hd_s),
    hd_l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS n FROM hd_t),
    hd_f AS (SELECT doc_id, line, n, starts_with(trim(line), '```') AS fence, sum(CASE WHEN starts_with(trim(line), '```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS k FROM hd_l),
    hd AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT fence AND k % 2 = 0 AND starts_with(ltrim(line), '#')), '') AS heads,
           coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE fence OR k % 2 = 1 OR NOT starts_with(ltrim(line), '#')), '') AS prose FROM hd_f GROUP BY doc_id)"""
_BODY = f"WITH {NOTES_SQL}, b AS (SELECT doc_id, CASE WHEN starts_with(text, '---') THEN substr(text, strpos(text, chr(10) || '---' || chr(10)) + 5) ELSE text END AS text FROM notes)"


@register(
    "chunk_first_window",
    f"""{_BODY}, {_HEADS},
    w AS (SELECT doc_id, text, heads, least(length(heads), 160) AS room FROM b JOIN hd USING (doc_id)),
    p AS (SELECT doc_id, text, heads, room, substr(text, 1, 1600 - room) AS part, right(substr(text, 1, 1600 - room), 400) AS tail FROM w),
    c AS (SELECT *, greatest(CASE WHEN strpos(reverse(tail), ' .') > 0 THEN length(tail) - strpos(reverse(tail), ' .') - 1 ELSE -1 END, CASE WHEN strpos(reverse(tail), chr(10)) > 0 THEN length(tail) - strpos(reverse(tail), chr(10)) ELSE -1 END) AS cut FROM p)
    SELECT doc_id, CASE WHEN length(text) > 1600 - room AND cut > 0 THEN substr(part, 1, length(part) - 400 + cut + 1) ELSE part END || CASE WHEN room > 0 THEN chr(10) || chr(10) || '## Outline' || chr(10) || substr(heads, 1, room) ELSE '' END AS chunk FROM c""",
)
def chunk_first_window(spark, sf):
    b = notes(spark, sf).select("doc_id", M.body(F.col("text")).alias("b"))
    return b.select("doc_id", chunking.first_window(F.col("b"), chunking.check_window(400)).alias("chunk"))


@register("chunk_header_aware", f"{_BODY}, {_HEADS} SELECT doc_id, substr(heads, 1, 533) || chr(10) || chr(10) || substr(prose, 1, 1600 - length(substr(heads, 1, 533))) AS chunk FROM hd")
def chunk_header_aware(spark, sf):
    b = notes(spark, sf).select("doc_id", M.body(F.col("text")).alias("b"))
    return b.select("doc_id", chunking.header_aware(F.col("b"), 400).alias("chunk"))


@register("chunk_index", "SELECT doc_id, CAST(s AS BIGINT) AS pos, substr(text, s + 1, 400) AS chunk FROM documents, unnest(range(0, greatest(length(text), 1), 360)) AS u(s)")
def chunk_index(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", F.explode(chunking.index_chunks(F.col("text"), 100, 10)).alias("c")).select("doc_id", F.col("c.pos").cast("long").alias("pos"), "c.chunk")


@register("char_tokens", "SELECT doc_id, CAST(len(regexp_extract_all(text, '(?s).{1,4}')) AS BIGINT) AS n, regexp_extract_all(text, '(?s).{1,4}')[-1] AS last FROM documents")
def char_tokens(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    t = X.char_tokens(F.col("text"))
    return d.select("doc_id", F.size(t).cast("long").alias("n"), F.try_element_at(t, F.lit(-1)).alias("last"))


@register("pdf_chunk_plan", "SELECT o_orderkey AS k, CASE WHEN n <= 100 THEN CAST(n AS VARCHAR) ELSE array_to_string([CAST(least(50, n - s) AS VARCHAR) FOR s IN range(0, n, 50)], ',') END AS plan FROM (SELECT o_orderkey, CAST(o_orderkey % 400 + 1 AS INTEGER) AS n FROM orders)")
def pdf_chunk_plan(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 400 + 1).cast("int").alias("n"))
    return o.select("k", F.array_join(chunking.page_plan(F.col("n")).cast("array<string>"), ",").alias("plan"))
