"""Queries of the detectors, repairs, Hebrew, glossaries, diagrams, graphs and the remaining operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.operators import campaign, conversion, dedup, detectors, graph, hebrew, repair, translation, vault
from quillspark.plans.registry import register
from quillspark.plans.synth import DEFECTS_SQL, content_lines_sql, defects

_CL = f"WITH {DEFECTS_SQL}, {content_lines_sql('docs', 'doc_id')}"


def _measured(name: str, columns: dict[str, str]):
    def q(spark, sf):
        found = detectors.run(defects(spark, sf), [name])
        return found.select("doc_id", "fired", *[F.col("measures")[k].cast(t).alias(k) for k, t in columns.items()])

    return q


#: The detectors' twins, for those of the census.
_DETECTED: dict[str, str] = {}


def _detector(name: str, columns: dict[str, str], oracle: str) -> None:
    _DETECTED[name] = oracle
    register(f"det_{name}", oracle)(_measured(name, columns))


_detector(
    "rtl_char_reversed",
    {"runs_total": "long", "runs_reversed": "long", "reversed_share": "double"},
    _CL + """, r AS (SELECT key, regexp_replace(unnest(regexp_extract_all(line, '[\\x{05D0}-\\x{05EA}\\x{05B0}-\\x{05C7}\\x{05F3}\\x{05F4}]+')), '[^\\x{05D0}-\\x{05EA}]', '', 'g') AS w FROM cl),
    s AS (SELECT key, count(*) AS n, count(*) FILTER (WHERE contains('ךםןףץ', w[1]) OR contains('כמנפצ', w[-1])) AS bad FROM r WHERE length(w) >= 2 GROUP BY key)
    SELECT doc_id, coalesce(n >= 5 AND bad / n >= 0.02, false) AS fired, CAST(coalesce(n, 0) AS BIGINT) AS runs_total, CAST(coalesce(bad, 0) AS BIGINT) AS runs_reversed, coalesce(round(bad / n, 4), 0.0) AS reversed_share FROM docs LEFT JOIN s ON key = doc_id""",
)
_detector(
    "rtl_order_reversed",
    {"lines_total": "long", "lines_leading_period": "long", "lines_mirrored_parens": "long", "dates_reversed": "long", "lines_flagged": "long"},
    _CL + """, l AS (SELECT key, trim(line, ' ' || chr(9)) AS x FROM cl),
    m AS (SELECT key, starts_with(x, '.') AS p, strpos(x, ')') > 0 AND (strpos(x, '(') = 0 OR strpos(x, ')') < strpos(x, '(')) AS q, len([t FOR t IN regexp_extract_all(x, '\\b\\d{2}-\\d{2}-\\d{4}\\b') IF try_cast(reverse(t) AS DATE) IS NOT NULL]) AS d FROM l WHERE x <> ''),
    s AS (SELECT key, count(*) AS n, count(*) FILTER (WHERE p) AS p, count(*) FILTER (WHERE q) AS q, sum(d) AS d, count(*) FILTER (WHERE p OR q OR d > 0) AS f FROM m GROUP BY key)
    SELECT doc_id, coalesce(n >= 5 AND f / n >= 0.02, false) AS fired, CAST(coalesce(n, 0) AS BIGINT) AS lines_total, CAST(coalesce(p, 0) AS BIGINT) AS lines_leading_period, CAST(coalesce(q, 0) AS BIGINT) AS lines_mirrored_parens, CAST(coalesce(d, 0) AS BIGINT) AS dates_reversed, CAST(coalesce(f, 0) AS BIGINT) AS lines_flagged FROM docs LEFT JOIN s ON key = doc_id""",
)
_detector("rtl_bidi_controls", {"control_count": "long", "controls_per_kchar": "double"}, f"WITH {DEFECTS_SQL}, c AS (SELECT doc_id, length(text) AS z, len(regexp_extract_all(text, '[\\x{{200E}}\\x{{200F}}\\x{{202A}}-\\x{{202E}}\\x{{2066}}-\\x{{2069}}]')) AS n FROM docs) SELECT doc_id, n > 0 AS fired, CAST(n AS BIGINT) AS control_count, CASE WHEN z > 0 THEN round(n / z * 1000, 3) ELSE 0.0 END AS controls_per_kchar FROM c")
_SIGNATURES = " OR ".join(f"starts_with(h, '{sig}')" for sig, _ in detectors.MAGIC)
_detector(
    "binary_magic_bytes",
    {"byte_size": "long", "ooxml": "long"},
    f"""WITH {DEFECTS_SQL}, x AS (SELECT doc_id, hex(raw) AS h, octet_length(raw) AS z FROM docs)
    SELECT doc_id, {_SIGNATURES} OR (starts_with(h, '52494646') AND substr(h, 17, 8) = '57415645') AS fired, CAST(z AS BIGINT) AS byte_size, CAST((starts_with(h, '504B0304') AND contains(substr(h, 1, 8192), hex(encode('[Content_Types].xml'))))::INT AS BIGINT) AS ooxml FROM x""",
)
_detector(
    "binary_byte_ratio",
    {"nul_bytes": "long", "decodable": "long", "control_chars": "long", "control_share": "double"},
    f"""WITH {DEFECTS_SQL}, x AS (SELECT doc_id, length(text) AS z, try(decode(raw)) IS NOT NULL AS ok, len([b FOR b IN regexp_extract_all(hex(raw), '..') IF b = '00']) AS nuls, len(regexp_extract_all(text, '[\\x01-\\x08\\x0b\\x0c\\x0e-\\x1f]')) AS c FROM docs),
    y AS (SELECT *, CASE WHEN ok THEN c ELSE 0 END AS n FROM x)
    SELECT doc_id, nuls > 0 OR NOT ok OR CASE WHEN z > 0 THEN n / z >= 0.02 ELSE false END AS fired, CAST(nuls AS BIGINT) AS nul_bytes, CAST(ok::INT AS BIGINT) AS decodable, CAST(n AS BIGINT) AS control_chars, CASE WHEN z > 0 THEN round(n / z, 4) ELSE 0.0 END AS control_share FROM y""",
)
_detector("base64_data_uri", {"blob_count": "long", "blob_chars": "long", "decoded_images": "long"}, f"WITH {DEFECTS_SQL}, c AS (SELECT doc_id, regexp_extract_all(text, 'data:([\\w.+-]+/[\\w.+-]+);base64,([A-Za-z0-9+/=\\s]{{40,}})', 2) AS b FROM docs) SELECT doc_id, len(b) > 0 AS fired, CAST(len(b) AS BIGINT) AS blob_count, CAST(coalesce(list_sum([length(x) FOR x IN b]), 0) AS BIGINT) AS blob_chars, CAST(len([x FOR x IN b IF length(regexp_replace(x, '\\s', '', 'g')) % 4 = 0 AND starts_with(x, 'iVBORw0KGgo')]) AS BIGINT) AS decoded_images FROM c")
_detector("base64_bare_blob", {"blob_count": "long", "decodable_blobs": "long", "blob_chars": "long"}, f"WITH {DEFECTS_SQL}, c AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9+/]{{512,}}={{0,2}}') AS b FROM docs) SELECT doc_id, len(b) > 0 AS fired, CAST(len(b) AS BIGINT) AS blob_count, CAST(len([x FOR x IN b IF length(x) % 4 = 0]) AS BIGINT) AS decodable_blobs, CAST(coalesce(list_sum([length(x) FOR x IN b]), 0) AS BIGINT) AS blob_chars FROM c")
_detector("image_placeholder", {"placeholder_count": "long"}, _CL + ", s AS (SELECT key, sum(len(regexp_extract_all(line, '<!--\\s*(image|formula-not-decoded)\\s*-->'))) AS n FROM cl GROUP BY key) SELECT doc_id, coalesce(n, 0) > 0 AS fired, CAST(coalesce(n, 0) AS BIGINT) AS placeholder_count FROM docs LEFT JOIN s ON key = doc_id")
_detector("image_empty_target", {"empty_target_count": "long"}, _CL + ", s AS (SELECT key, sum(len(regexp_extract_all(line, '!\\[[^\\]]*\\]\\(\\s*\\)'))) AS n FROM cl GROUP BY key) SELECT doc_id, coalesce(n, 0) > 0 AS fired, CAST(coalesce(n, 0) AS BIGINT) AS empty_target_count FROM docs LEFT JOIN s ON key = doc_id")

_SEP = "regexp_matches(line, '^\\s*\\|?[\\s:|-]+\\|[\\s:|-]*$')"
_BLOCKS = _CL + f""", o AS (SELECT key, line_no, line, length(line) - length(replace(line, '|', '')) AS pipes, row_number() OVER (PARTITION BY key ORDER BY line_no) AS r FROM cl),
    i AS (SELECT *, r - row_number() OVER (PARTITION BY key ORDER BY line_no) AS isle FROM o WHERE pipes >= 2),
    k AS (SELECT *, count(*) OVER (PARTITION BY key, isle) AS size, {_SEP} AS sep FROM i), bl AS (SELECT * FROM k WHERE size >= 3)"""
_CELLS = "[trim(c) FOR c IN string_split(trim(trim(line), '|'), '|')]"
_detector(
    "table_pipe_inconsistent",
    {"table_rows": "long", "deviating_rows": "long", "deviating_share": "double"},
    _BLOCKS + """, dt AS (SELECT key, isle, pipes, line_no, count(*) OVER (PARTITION BY key, isle) AS n FROM bl WHERE NOT sep),
    mo AS (SELECT key, isle, pipes, row_number() OVER (PARTITION BY key, isle ORDER BY count(*) DESC, min(line_no)) AS r FROM dt WHERE n >= 2 GROUP BY key, isle, pipes),
    s AS (SELECT dt.key, count(*) AS n, count(*) FILTER (WHERE dt.pipes <> mo.pipes) AS bad FROM dt JOIN mo ON mo.key = dt.key AND mo.isle = dt.isle AND mo.r = 1 WHERE dt.n >= 2 GROUP BY dt.key)
    SELECT doc_id, coalesce(n >= 3 AND bad / n >= 0.1, false) AS fired, CAST(coalesce(n, 0) AS BIGINT) AS table_rows, CAST(coalesce(bad, 0) AS BIGINT) AS deviating_rows, coalesce(round(bad / n, 4), 0.0) AS deviating_share FROM docs LEFT JOIN s ON s.key = doc_id""",
)
_detector(
    "table_cell_fragmented",
    {"cells_total": "long", "cells_fragmented": "long", "fragmented_share": "double"},
    _BLOCKS + f""", ce AS (SELECT key, unnest({_CELLS}) AS c FROM bl WHERE NOT sep), s AS (SELECT key, count(*) AS n, count(*) FILTER (WHERE length(c) <= 3 AND NOT regexp_matches(c, '^\\p{{N}}+$')) AS bad FROM ce WHERE c <> '' GROUP BY key)
    SELECT doc_id, coalesce(n > 0 AND bad / n >= 0.35, false) AS fired, CAST(coalesce(n, 0) AS BIGINT) AS cells_total, CAST(coalesce(bad, 0) AS BIGINT) AS cells_fragmented, coalesce(round(bad / n, 4), 0.0) AS fragmented_share FROM docs LEFT JOIN s ON s.key = doc_id""",
)
_detector(
    "table_shape_implausible",
    {"table_blocks": "long", "max_columns": "long", "empty_header_rows": "long"},
    _BLOCKS + f""", ce AS (SELECT key, isle, line_no, sep, {_CELLS} AS cs FROM bl), h AS (SELECT key, isle, arg_min(cs, line_no) FILTER (WHERE NOT sep) AS hd FROM ce GROUP BY key, isle),
    s AS (SELECT key, count(DISTINCT isle) AS n, coalesce(max(len(cs)) FILTER (WHERE NOT sep), 0) AS w FROM ce GROUP BY key), e AS (SELECT key, count(*) FILTER (WHERE hd IS NOT NULL AND len([c FOR c IN hd IF c <> '']) = 0) AS b FROM h GROUP BY key)
    SELECT doc_id, coalesce(w > 12 OR b > 0, false) AS fired, CAST(coalesce(n, 0) AS BIGINT) AS table_blocks, CAST(coalesce(w, 0) AS BIGINT) AS max_columns, CAST(coalesce(b, 0) AS BIGINT) AS empty_header_rows FROM docs LEFT JOIN s ON s.key = doc_id LEFT JOIN e ON e.key = doc_id""",
)
_detector("split_opens_midsentence", {"starts_punctuation": "long", "starts_lowercase": "long"}, _CL + ", f AS (SELECT key, arg_min(trim(line), line_no) AS x FROM cl WHERE trim(line) <> '' GROUP BY key) SELECT doc_id, coalesce(regexp_matches(x, '^[,;:)\\]}\\x{05BE}]') OR regexp_matches(x, '^\\p{Ll}'), false) AS fired, CAST(coalesce(regexp_matches(x, '^[,;:)\\]}\\x{05BE}]'), false)::INT AS BIGINT) AS starts_punctuation, CAST(coalesce(regexp_matches(x, '^\\p{Ll}'), false)::INT AS BIGINT) AS starts_lowercase FROM docs LEFT JOIN f ON key = doc_id")
_detector("split_no_title", {"has_heading": "long", "has_frontmatter_title": "long"}, _CL + ", f AS (SELECT key, line, row_number() OVER (PARTITION BY key ORDER BY line_no) AS r FROM cl WHERE trim(line) <> ''), g AS (SELECT key, bool_or(r <= 3 AND starts_with(ltrim(line), '#')) AS h FROM f GROUP BY key), t AS (SELECT doc_id, regexp_matches(text, '^---\\n(?:[^\\n]*\\n)*?title:[^\\n]*[^\\s\\n][^\\n]*\\n(?:[^\\n]*\\n)*?---\\n') AS ti FROM docs) SELECT doc_id, NOT (coalesce(h, false) OR ti) AS fired, CAST(coalesce(h, false)::INT AS BIGINT) AS has_heading, CAST(ti::INT AS BIGINT) AS has_frontmatter_title FROM t LEFT JOIN g ON key = doc_id")


def _image_files(d):
    return d.where("doc_id % 3 = 1").select(F.concat(F.lit("docs/d"), (F.col("doc_id") % 3).cast("string"), F.lit("/pics/a.png")).alias("path"))


def _census(spark, sf):
    d = defects(spark, sf)
    return detectors.census(d, _image_files(d))


_BROKEN = _CL + """, r AS (SELECT key, unnest(regexp_extract_all(line, '!\\[[^\\]]*\\]\\(\\s*([^)\\s]+)', 1)) AS t FROM cl), q AS (SELECT key, t FROM r WHERE NOT regexp_matches(t, '(?i)^(https?:|data:|#|mailto:)')),
    s AS (SELECT key, count(*) AS n, count(*) FILTER (WHERE 'docs/d' || CAST(key % 3 AS VARCHAR) || '/' || t NOT IN (SELECT 'docs/d' || CAST(s.doc_id % 3 AS VARCHAR) || '/pics/a.png' FROM docs s WHERE s.doc_id % 3 = 1)) AS bad FROM q GROUP BY key)
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS ref_count, CAST(coalesce(bad, 0) AS BIGINT) AS broken_count FROM docs LEFT JOIN s ON key = doc_id"""


@register("det_image_broken_ref", _BROKEN)
def det_image_broken_ref(spark, sf):
    d = defects(spark, sf)
    return detectors.broken_images(d, _image_files(d)).select("doc_id", "ref_count", "broken_count")


_LENGTHS = f"WITH {DEFECTS_SQL}, s AS (SELECT octet_length(raw) AS z, row_number() OVER (ORDER BY octet_length(raw)) - 1 AS r, count(*) OVER () AS n FROM docs), p AS (SELECT max(z) FILTER (WHERE r = round_even(0.95 * (n - 1), 0)) AS p95 FROM s) SELECT doc_id, length(text) < 200 OR length(text) > 3 * p95 AS fired, CAST(length(text) AS BIGINT) AS char_count FROM docs, p"


@register("det_split_length_outlier", _LENGTHS)
def det_split_length_outlier(spark, sf):
    return detectors.length_outliers(defects(spark, sf)).select("doc_id", "fired", F.col("measures")["char_count"].cast("long").alias("char_count"))


_FINDINGS = "f AS (" + " UNION ALL ".join(
    f"SELECT doc_id, '{name}' AS detector, '{detectors.REGISTRY[name].route}' AS route, fired FROM ({sql})" for name, sql in _DETECTED.items()
) + f" UNION ALL SELECT doc_id, 'image_broken_ref', 'reconvert', broken_count > 0 FROM ({_BROKEN}) UNION ALL SELECT doc_id, 'split_length_outlier', 'resplit', fired FROM ({_LENGTHS}))"


@register("census_fire_counts", f"WITH {_FINDINGS} SELECT detector, CAST(count(*) FILTER (WHERE fired) AS BIGINT) AS fired, round(count(*) FILTER (WHERE fired) / count(*), 4) AS share FROM f GROUP BY detector")
def census_fire_counts(spark, sf):
    return detectors.fire_counts(_census(spark, sf))


@register("census_routes", f"WITH {_FINDINGS} SELECT route, CAST(count(DISTINCT doc_id) AS BIGINT) AS docs FROM f WHERE fired AND route <> 'none' GROUP BY route")
def census_routes(spark, sf):
    return detectors.route_totals(_census(spark, sf))


@register("census_cooccurrence", f"WITH {_FINDINGS} SELECT a.detector AS a, b.detector AS b, CAST(count(*) AS BIGINT) AS n FROM f a JOIN f b USING (doc_id) WHERE a.fired AND b.fired AND a.detector < b.detector GROUP BY ALL ORDER BY n DESC, a, b LIMIT 25")
def census_cooccurrence(spark, sf):
    return detectors.cooccurrence(_census(spark, sf))


@register("recon_accept", f"WITH {_FINDINGS}, s AS (SELECT doc_id, count(*) AS old, count(*) FILTER (WHERE detector <> 'split_no_title') AS new FROM f WHERE fired GROUP BY doc_id) SELECT doc_id, new < old AS accepted FROM s")
def recon_accept(spark, sf):
    # Once through the texts for both sides; only those that fire are stored.
    old = graph.cut_lineage(_census(spark, sf).where("fired").select("doc_id", "detector", "fired"))
    new = old.withColumn("fired", F.col("fired") & (F.col("detector") != "split_no_title"))
    return detectors.accept_reconversion(new, old)


@register("detector_registry", "SELECT * FROM (VALUES " + ", ".join(f"('{d.name}', '{d.route}', {d.version}, CAST({float(d.threshold)} AS DOUBLE))" for d in (*detectors.REGISTRY.values(), *detectors.CORPUS_DETECTORS)) + ") t(detector, route, version, threshold)")
def detector_registry(spark, sf):
    return detectors.registry_table(spark)


@register("census_samples", _CL + f""", w AS ({_FINDINGS.removeprefix("f AS (")[:-1]}), p AS (SELECT detector, doc_id, row_number() OVER (PARTITION BY detector ORDER BY doc_id) AS pick FROM w WHERE fired),
    l AS (SELECT key, substr(trim(line, ' ' || chr(9)), 1, 120) AS x, row_number() OVER (PARTITION BY key ORDER BY line_no) AS r FROM cl WHERE trim(line, ' ' || chr(9)) <> ''),
    t AS (SELECT key, string_agg(x, chr(10) ORDER BY r) AS samples FROM l WHERE r <= 3 GROUP BY key)
    SELECT detector, doc_id, coalesce(samples, '') AS samples FROM p LEFT JOIN t ON key = doc_id WHERE pick <= 5""")
def census_samples(spark, sf):
    d = defects(spark, sf)
    return detectors.samples(detectors.census(d, _image_files(d)), d).select("detector", "doc_id", F.array_join("samples", "\n").alias("samples"))


@register("repair_char_runs")
def repair_char_runs(spark, sf):
    return repair.reverse_runs(defects(spark, sf)).select("doc_id", "repaired", "healed")


@register("repair_base64", f"WITH {DEFECTS_SQL}, c AS (SELECT doc_id, text, regexp_extract(text, 'data:[\\w.+-]+/[\\w.+-]+;base64,[A-Za-z0-9+/=\\s]{{40,}}') AS u FROM docs), i AS (SELECT *, regexp_replace(regexp_replace(u, '^[^,]*,', ''), '\\s', '', 'g') AS b FROM c), g AS (SELECT *, u <> '' AND length(b) % 4 = 0 AND starts_with(b, 'iVBORw0KGgo') AS img FROM i) SELECT doc_id, CAST(img::INT AS BIGINT) AS blobs FROM g")
def repair_base64(spark, sf):
    return repair.extract_base64(defects(spark, sf)).select("doc_id", F.size("blobs").cast("long").alias("blobs"))


#: Hebrew texts of every document, from its id.
_HEB = "'שלום עולם ' || CASE doc_id % 4 WHEN 0 THEN 'אבג דאה אבג' WHEN 1 THEN 'םולש גבא' WHEN 2 THEN 'דאה גבא' ELSE 'שלום' END || ' ' || text"


@register("heb_ngram_counts", f"""WITH t AS (SELECT regexp_extract_all({_HEB}, '[\\x{{0590}}-\\x{{05FF}}]+') AS t FROM documents),
    e AS (SELECT 'word' AS kind, unnest(t) AS item FROM t UNION ALL SELECT 'phrase', unnest([array_to_string(t[i:i + 1], ' ') FOR i IN range(1, len(t))]) FROM t UNION ALL SELECT 'phrase', unnest([array_to_string(t[i:i + 2], ' ') FOR i IN range(1, len(t) - 1)]) FROM t)
    SELECT kind, item, CAST(count(*) AS BIGINT) AS n FROM e GROUP BY ALL""")
def heb_ngram_counts(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").selectExpr(f"{_HEB} AS h")
    return hebrew.counts(d, "h")


@register("heb_dict_merge", f"""WITH t AS (SELECT unnest(regexp_extract_all({_HEB}, '[\\x{{0590}}-\\x{{05FF}}]+')) AS item FROM documents) SELECT item, CAST(2 * count(*) AS BIGINT) AS n FROM t GROUP BY item""")
def heb_dict_merge(spark, sf):
    c = hebrew.counts(spark.read.parquet(f"{sf}/documents.parquet").selectExpr(f"{_HEB} AS h"), "h")
    return hebrew.merged(c, c).where("kind = 'word'").select("item", "n")


@register("heb_word_fix", f"""WITH t AS (SELECT unnest(regexp_extract_all({_HEB}, '[\\x{{0590}}-\\x{{05FF}}]+')) AS w FROM documents), f AS (SELECT w, count(*) / (SELECT count(*) FROM t) AS f FROM t GROUP BY w), x AS (SELECT DISTINCT w AS word, o AS ocr FROM t, (VALUES (true), (false)) v(o)),
    j AS (SELECT word, ocr, contains('םןךףץ', word[1]) AS fin, coalesce(a.f, 0) AS cur, coalesce(b.f, 0) AS rev FROM x LEFT JOIN f a ON a.w = word LEFT JOIN f b ON b.w = reverse(word)),
    d AS (SELECT word, ocr, CASE WHEN length(word) < 2 OR (NOT fin AND NOT ocr) THEN 'keep' WHEN rev < 1e-5 OR rev <= CASE WHEN fin THEN 0 ELSE cur END THEN 'keep' WHEN CASE WHEN fin THEN 0 ELSE cur END = 0 OR rev >= 2 * CASE WHEN fin THEN 0 ELSE cur END THEN 'fix' ELSE 'ambiguous' END AS decision FROM j)
    SELECT word, ocr, decision, CASE WHEN decision = 'fix' THEN reverse(word) ELSE word END AS fixed FROM d""")
def heb_word_fix(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").selectExpr(f"{_HEB} AS h")
    words = d.select(F.explode(hebrew.tokens(F.col("h"))).alias("word")).distinct().select("word", F.explode(F.array(F.lit(True), F.lit(False))).alias("ocr"))
    return hebrew.fix_words(words, hebrew.counts(d, "h"))


@register("heb_phrase_fix")
def heb_phrase_fix(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", f"{_HEB} AS h", "doc_id % 2 = 0 AS ocr")
    return hebrew.fix_texts(d, hebrew.counts(d, "h"), "h", "ocr").select("doc_id", "repair.*")


_GLOSS = "g AS (SELECT 'part ' || p_type AS term, CASE p_size % 3 WHEN 0 THEN 'organisation' WHEN 1 THEN 'domain' ELSE 'subdomain' END AS layer, min(p_brand || CAST(p_size % 4 AS STRING)) AS english, CAST(NULL AS STRING) AS overrides FROM part GROUP BY ALL)"


def _gloss(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    return p.groupBy(F.concat(F.lit("part "), "p_type").alias("term"), F.when(F.col("p_size") % 3 == 0, "organisation").when(F.col("p_size") % 3 == 1, "domain").otherwise("subdomain").alias("layer")).agg(F.min(F.concat("p_brand", (F.col("p_size") % 4).cast("string"))).alias("english"), F.lit(None).cast("string").alias("overrides"))


_RANK = "list_position(['subdomain', 'domain', 'organisation'], layer)"


@register("glossary_layer_resolve", f"WITH {_GLOSS} SELECT term, arg_min(english, {_RANK}) AS english, arg_min(layer, {_RANK}) AS layer FROM g GROUP BY term")
def glossary_layer_resolve(spark, sf):
    g = _gloss(spark, sf)
    return translation.resolve(g.select("term").distinct(), g)


@register("glossary_collision", f"WITH {_GLOSS} SELECT 'shared_rendering' AS kind, english AS item, CAST(count(DISTINCT term) AS BIGINT) AS n FROM g GROUP BY english HAVING count(DISTINCT term) > 1")
def glossary_collision(spark, sf):
    return translation.collisions(_gloss(spark, sf))


@register("glossary_overrides", f"WITH {_GLOSS}, r AS (SELECT *, {_RANK} AS r FROM g) SELECT DISTINCT a.term, a.layer FROM r a JOIN r b ON a.term = b.term AND b.r > a.r AND b.english <> a.english WHERE a.overrides IS NULL")
def glossary_overrides(spark, sf):
    return translation.unregistered_overrides(_gloss(spark, sf))


@register("qa_glossary_consistency", f"WITH {_GLOSS} SELECT term, CAST(count(DISTINCT english) AS BIGINT) AS n FROM g GROUP BY term HAVING count(DISTINCT english) > 1")
def qa_glossary_consistency(spark, sf):
    return translation.inconsistent(_gloss(spark, sf))


_PAIR = "p AS (SELECT doc_id, '# A' || chr(10) || text || ' 12.5% 7' AS source, CASE doc_id % 3 WHEN 0 THEN '# A' || chr(10) || text || ' 7 12.5%' WHEN 1 THEN '## A' || chr(10) || text || ' 12.5%' ELSE '# A' || chr(10) || 'short 7 ⟦he:שלום⟧' END AS target FROM documents)"


@register("qa_fidelity", f"WITH {_PAIR}, n AS (SELECT doc_id, list_sort(regexp_extract_all(source, '[0-9]+(?:[.,][0-9]+)*%?')) = list_sort(regexp_extract_all(target, '[0-9]+(?:[.,][0-9]+)*%?')) AS numeric, length(target)::DOUBLE / greatest(length(source), 1) AS r, NOT contains(target, '⟦he:') AS markers FROM p) SELECT doc_id, numeric AS numeric_fidelity, r >= 0.5 AND r <= 2.5 AS length_ratio, markers AS marker_free FROM n")
def qa_fidelity(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "'# A' || chr(10) || text || ' 12.5% 7' AS source", "CASE doc_id % 3 WHEN 0 THEN '# A' || chr(10) || text || ' 7 12.5%' WHEN 1 THEN '## A' || chr(10) || text || ' 12.5%' ELSE '# A' || chr(10) || 'short 7 ⟦he:שלום⟧' END AS target")
    c = translation.checks(F.col("source"), F.col("target"))
    return d.select("doc_id", *[c[k].alias(k) for k in ("numeric_fidelity", "length_ratio", "marker_free")])


@register("qa_quarantine", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'heading_fidelity' || CASE WHEN (length(text) + 10)::DOUBLE / (length(text) + 4) > 2.5 THEN ',length_ratio' ELSE '' END || ',marker_free' END AS failed FROM documents")
def qa_quarantine(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "'# A' || chr(10) || text AS source", "CASE WHEN doc_id % 3 = 0 THEN '# A' || chr(10) || text ELSE '## B' || chr(10) || text || ' ⟦he:x⟧' END AS target")
    return translation.quarantined(d).select("doc_id", F.array_join("failed", ",").alias("failed"))


@register("qa_term_spread", "SELECT source AS term, CAST(count(*) AS BIGINT) AS freq, CAST(count(DISTINCT lang) AS BIGINT) AS domains FROM documents GROUP BY source")
def qa_term_spread(spark, sf):
    return translation.term_spread(spark.read.parquet(f"{sf}/documents.parquet").select(F.col("source").alias("term"), F.col("lang").alias("domain")))


# Graphs: parts and suppliers of the line items.
_E = "e AS (SELECT DISTINCT 'p' || CAST(l_partkey AS STRING) AS src, 's' || CAST(l_suppkey AS STRING) AS dst FROM lineitem)"


def _edges(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return li.select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("src"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst")).distinct()


@register("graph_degree", f"WITH {_E} SELECT node, CAST(count(*) AS BIGINT) AS degree FROM (SELECT src AS node FROM e UNION ALL SELECT dst FROM e) GROUP BY node")
def graph_degree(spark, sf):
    return graph.degrees(_edges(spark, sf))


@register("graph_god_nodes", f"WITH {_E} SELECT node, CAST(count(*) AS BIGINT) AS degree FROM (SELECT src AS node FROM e UNION ALL SELECT dst FROM e) GROUP BY node ORDER BY degree DESC, node LIMIT 10")
def graph_god_nodes(spark, sf):
    return graph.god_nodes(_edges(spark, sf))


# Orders lead from each customer to the next order's customer: a graph with long paths.
_C = "e AS (SELECT DISTINCT o_custkey AS src, (o_custkey * 3 + 1) % 1500 AS dst FROM orders)"


def _chain(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select(F.col("o_custkey").alias("src"), ((F.col("o_custkey") * 3 + 1) % 1500).alias("dst")).distinct()


@register("graph_bfs", f"WITH RECURSIVE {_C}, r(node, depth) AS (SELECT CAST(1 AS BIGINT), 0 UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node WHERE r.depth < 6) SELECT node, min(depth) AS depth FROM r GROUP BY node")
def graph_bfs(spark, sf):
    return graph.reachable(_chain(spark, sf), [1], 6)


@register("graph_components", f"WITH RECURSIVE {_C}, b AS (SELECT src AS u, dst AS v FROM e UNION SELECT dst, src FROM e), r(node, root) AS (SELECT DISTINCT u, u FROM b UNION SELECT b.v, r.root FROM r JOIN b ON b.u = r.node AND r.root < b.v) SELECT node, min(root) AS component FROM r GROUP BY node")
def graph_components(spark, sf):
    return graph.components(_chain(spark, sf))


@register("graph_isolated", f"WITH {_C}, d AS (SELECT node, count(*) AS degree FROM (SELECT src AS node FROM e UNION ALL SELECT dst FROM e) GROUP BY node) SELECT c_custkey AS node, CAST(coalesce(degree, 0) AS BIGINT) AS degree FROM customer LEFT JOIN d ON node = c_custkey WHERE coalesce(degree, 0) <= 1")
def graph_isolated(spark, sf):
    nodes = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("node"))
    return graph.isolated(nodes, _chain(spark, sf))


@register("graph_surprising", "SELECT DISTINCT 'p' || CAST(l_partkey AS VARCHAR) AS src, 'p' || CAST(l_partkey + 1 AS VARCHAR) AS dst, CAST(a.p_size AS VARCHAR) AS src_file, CAST(b.p_size AS VARCHAR) AS dst_file FROM lineitem JOIN part a ON a.p_partkey = l_partkey JOIN part b ON b.p_partkey = l_partkey + 1 WHERE l_returnflag = 'R' AND a.p_size <> b.p_size")
def graph_surprising(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    e = li.select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("src"), F.concat(F.lit("p"), (F.col("l_partkey") + 1).cast("string")).alias("dst"), F.when(F.col("l_returnflag") == "R", "INFERRED").otherwise("EXTRACTED").alias("confidence"), F.lit("semantically_similar_to").alias("relation")).distinct()
    nodes = spark.read.parquet(f"{sf}/part.parquet").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node"), F.col("p_size").cast("string").alias("file"))
    return graph.surprising(e, nodes)


@register("graph_betweenness")
def graph_betweenness(spark, sf):
    n = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("src"), (F.col("n_nationkey") * 3 % 25).alias("dst"))
    return graph.betweenness(n)


@register("graph_communities")
def graph_communities(spark, sf):
    e = _chain(spark, sf)
    return graph.cohesion(e, graph.communities(e))


@register("vsdx_edges", """WITH s AS (SELECT p_partkey AS shape, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name || ' [x]|' END AS text FROM part), c AS (SELECT l_orderkey AS connector, l_linenumber AS ord, l_partkey AS shape FROM lineitem),
    o AS (SELECT *, row_number() OVER (PARTITION BY connector ORDER BY ord, CAST(shape AS VARCHAR)) AS r FROM c), p AS (SELECT connector, max(shape) FILTER (WHERE r = 1) AS a, max(shape) FILTER (WHERE r = 2) AS b FROM o GROUP BY connector HAVING max(r) >= 2),
    l AS (SELECT shape, translate(CASE WHEN length(trim(text)) > 40 THEN substr(trim(text), 1, 39) || '…' ELSE trim(text) END, '[]{}|', '()()/') AS label FROM s)
    SELECT connector, coalesce(nullif(x.label, ''), 'Shape ' || CAST(a AS VARCHAR)) AS source, coalesce(nullif(y.label, ''), 'Shape ' || CAST(b AS VARCHAR)) AS target FROM p LEFT JOIN l x ON x.shape = a LEFT JOIN l y ON y.shape = b""")
def vsdx_edges(spark, sf):
    shapes = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").cast("string").alias("shape"), F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.concat("p_name", F.lit(" [x]|"))).alias("text"))
    connects = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("connector"), F.col("l_linenumber").alias("ord"), F.col("l_partkey").cast("string").alias("shape"))
    return conversion.diagram_edges(shapes, connects)


@register("attach_names", """WITH a AS (SELECT l_orderkey AS mail, l_linenumber AS ord, CASE l_linenumber % 3 WHEN 0 THEN '..' WHEN 1 THEN 'x/report.pdf' ELSE 'report.pdf' END AS name FROM lineitem), b AS (SELECT *, CASE WHEN regexp_extract(name, '[^/]*$') IN ('', '.', '..') THEN 'attachment.md' ELSE regexp_extract(name, '[^/]*$') END AS base FROM a),
    c AS (SELECT *, row_number() OVER (PARTITION BY mail, base ORDER BY ord) - 1 AS n FROM b) SELECT mail, ord, name, CASE WHEN n = 0 THEN base ELSE regexp_replace(base, '\\.[^.]*$', '') || '_' || CAST(n AS VARCHAR) || regexp_extract(base, '(\\.[^.]*)$', 1) END AS safe_name FROM c""")
def attach_names(spark, sf):
    a = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("mail"), F.col("l_linenumber").alias("ord"), F.when(F.col("l_linenumber") % 3 == 0, "..").when(F.col("l_linenumber") % 3 == 1, "x/report.pdf").otherwise("report.pdf").alias("name"))
    return conversion.attachment_names(a)


@register("upgrade_diff", "WITH prev AS (SELECT p_partkey AS path, p_brand AS sha FROM part WHERE p_partkey % 3 <> 0), pack AS (SELECT p_partkey AS path, p_brand AS sha FROM part WHERE p_partkey % 3 <> 1), disk AS (SELECT p_partkey AS path, CASE WHEN p_partkey % 4 = 0 THEN 'drift' ELSE p_brand END AS sha FROM part WHERE p_partkey % 5 <> 0) SELECT path, 'delete_orphan' AS action FROM prev WHERE path NOT IN (SELECT path FROM pack) UNION ALL SELECT pack.path, CASE WHEN disk.sha IS NULL THEN 'lay' WHEN disk.sha <> pack.sha THEN 'backup_and_lay' ELSE 'keep' END FROM pack LEFT JOIN disk USING (path)")
def upgrade_diff(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("path"), F.col("p_brand").alias("sha"))
    k = F.col("path")
    disk = p.where(k % 5 != 0).withColumn("sha", F.when(k % 4 == 0, "drift").otherwise(F.col("sha")))
    return dedup.upgrade_plan(p.where(k % 3 != 0), p.where(k % 3 != 1), disk)


@register("convert_routing", "SELECT converter, status, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE doc_id % 5 WHEN 0 THEN 'docling' WHEN 1 THEN 'pandoc' WHEN 2 THEN 'markitdown' WHEN 3 THEN 'eml' END AS converter, CASE WHEN doc_id % 5 = 4 THEN 'skipped' ELSE 'pending' END AS status FROM documents) GROUP BY ALL")
def convert_routing(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("'raw/' || CAST(doc_id AS STRING) || element_at(array('.PDF', '.html', '.txt', '.eml', '.bin'), CAST(doc_id % 5 + 1 AS INT)) AS path")
    return conversion.route(d).groupBy("converter", "status").agg(F.count("*").alias("n"))


@register("expand_parse", """WITH q AS (SELECT conv_id, turn, 'lex: ' || split_part(text, ' ', 1) || ' x' || chr(10) || 'vec: nothing here' || chr(10) || 'junk' AS t, split_part(text, ' ', 1) AS q FROM conversations WHERE regexp_matches(text, '^[A-Z][a-z]{2,} '))
    SELECT conv_id, turn, 'lex' AS kind, q || ' x' AS text FROM q WHERE lower(q) NOT IN ('nothing', 'here')""")
def expand_parse(spark, sf):
    c = spark.read.parquet(f"{sf}/conversations.parquet").where(F.col("text").rlike("^[A-Z][a-z]{2,} "))
    q = F.substring_index("text", " ", 1)
    t = F.concat(F.lit("lex: "), q, F.lit(" x\nvec: nothing here\njunk"))
    return c.where(~F.lower(q).isin("nothing", "here")).select("conv_id", "turn", F.explode(X.expansion_lines(t, q)).alias("e")).select("conv_id", "turn", "e.kind", "e.text")


@register("rerank_score", "SELECT event_id, round(CASE WHEN event_id % 5 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 1.0 ELSE 0.0 END ELSE exp(-value / 100) / (exp(-value / 100) + exp(CASE WHEN event_id % 3 = 0 THEN -100 ELSE -1 END::DOUBLE)) END, 6) AS score FROM events WHERE value IS NOT NULL")
def rerank_score(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").where("value IS NOT NULL")
    k = F.col("event_id")
    yes = F.when(k % 5 != 0, -F.col("value") / 100)
    no = F.when((k % 5 != 0) & (k % 3 != 0), F.lit(-1.0))
    return e.select("event_id", F.round(X.rerank_score(yes, no, F.when(k % 2 == 0, "Yes, it is").otherwise("no")), 6).alias("score"))


@register("campaign_collisions", "WITH o AS (SELECT s_nationkey AS concept, min(s_name) AS known, CAST(min(s_suppkey) % 3 AS INT) AS kt FROM supplier GROUP BY 1), n AS (SELECT n_nationkey AS concept, 'Supplier#000000001' AS claim, n_regionkey % 3 AS tier FROM nation) SELECT n.concept, CASE WHEN known IS NULL THEN 'extend' WHEN known = claim THEN 'agree' WHEN tier < kt THEN 'override' WHEN tier = kt THEN 'conflict' ELSE 'keep' END AS outcome FROM n LEFT JOIN o USING (concept)")
def campaign_collisions(spark, sf):
    o = spark.read.parquet(f"{sf}/supplier.parquet").groupBy(F.col("s_nationkey").alias("concept")).agg(F.min("s_name").alias("known"), (F.min("s_suppkey") % 3).cast("int").alias("kt"))
    n = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("concept"), F.lit("Supplier#000000001").alias("claim"), (F.col("n_regionkey") % 3).alias("tier"))
    return campaign.collide(o, n)


@register("campaign_levels", "WITH RECURSIVE n AS (SELECT n_nationkey AS item FROM nation), d AS (SELECT n_nationkey AS item, n_nationkey // 2 AS needed FROM nation WHERE n_nationkey > 0), r(item, level) AS (SELECT item, 0 FROM n WHERE item = 0 UNION ALL SELECT d.item, r.level + 1 FROM r JOIN d ON d.needed = r.item) SELECT item, level FROM r")
def campaign_levels(spark, sf):
    n = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("item"))
    return graph.topological_levels(n, n.where("item > 0").select("item", F.floor(F.col("item") / 2).cast("int").alias("needed")))


@register("ingest_registry", "SELECT slug, title FROM (SELECT trim(regexp_replace(lower(trim(source || ' note')), '[^a-z0-9]+', '-', 'g'), '-') AS slug, source || ' note' AS title FROM documents) GROUP BY ALL")
def ingest_registry(spark, sf):
    from quillspark.plans.synth import notes

    registry = spark.createDataFrame([], "slug string")
    return vault.ingest(notes(spark, sf).where("doc_id >= 0").select("stem", "text"), registry, "2026-01-01").select("slug", "title")


@register("accept_frontmatter")
def accept_frontmatter(spark, sf):
    from quillspark.plans.synth import notes

    return notes(spark, sf).where("doc_id >= 0").select("doc_id", vault.accepted_text(F.col("text"), F.lit("alpha"), F.array(F.lit("beta")), F.lit("high")).alias("text"))
