"""Inputs that the driver's tables lack, made of them by expressions that Spark and DuckDB read alike.

The documents are plain prose; a vault of linked markdown notes, judge verdicts,
diagrams and so on are derived from every row and its whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_STEM = "'doc-' || CAST(CASE WHEN doc_id % 97 = 13 THEN doc_id - 1 ELSE doc_id END AS STRING)"
_FOLDER = "CASE doc_id % 5 WHEN 0 THEN 'raw' WHEN 1 THEN 'wiki' WHEN 2 THEN 'wiki' WHEN 3 THEN 'wiki/sources' ELSE 'index' END"
_TEXT = (
    "'---' || chr(10) || 'title: \"' || source || ' note\"' || chr(10) || 'tags:' || chr(10) || '- ' || lang || chr(10) || '- t' || CAST(doc_id % 7 AS STRING) || chr(10)"
    " || CASE WHEN doc_id % 11 = 0 THEN 'type: index' || chr(10) ELSE '' END"
    " || CASE WHEN doc_id % 3 = 0 THEN 'sources:' || chr(10) || '- \"[[doc-' || CAST((doc_id * 5) % 200 AS STRING) || ']]\"' || chr(10) ELSE '' END"
    " || '---' || chr(10) || '# Head ' || CAST(doc_id AS STRING) || chr(10) || text || chr(10) || '```' || chr(10) || '# fenced [[doc-1]]' || chr(10) || '```' || chr(10)"
    " || '## More' || chr(10) || 'See [[doc-' || CAST((doc_id * 7 + 1) % 200 AS STRING) || '|alias]] and [[doc-' || CAST((doc_id * 3) % 211 AS STRING) || '#sec]].' || chr(10)"
    " || CASE WHEN doc_id % 29 = 0 THEN '<!-- TODO: fill -->' || chr(10) ELSE '' END"
)
NOTE_COLUMNS = {"doc_id": "doc_id", "stem": _STEM, "folder": _FOLDER, "path": f"({_FOLDER}) || '/' || ({_STEM}) || '-' || CAST(doc_id AS STRING) || '.md'", "text": _TEXT}
_LOG = "'## [2026-01-01] ingest | doc-0' || chr(10) || '## [2026-01-02] ingest | doc-5' || chr(10) || '## [2026-01-03] ingest | doc-25'"
_MAP = "'[[doc-3]] [[doc-4]] [[log]]'"
_EXTRA = [("-1", "'log'", "'index'", "'index/log.md'", _LOG), ("-2", "'_map-of-content'", "'index'", "'index/_map-of-content.md'", _MAP), ("-3", "'registry'", "'index'", "'index/registry.md'", "'| doc-0 | a |' || chr(10) || '| doc-10 | b |'")]


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = docs.selectExpr(*[f"{e} AS {c}" for c, e in NOTE_COLUMNS.items()])
    for row in _EXTRA:
        out = out.union(spark.range(1).selectExpr(f"CAST({row[0]} AS BIGINT) AS doc_id", *[f"{e} AS {c}" for e, c in zip(row[1:], ("stem", "folder", "path", "text"), strict=True)]))
    return out


NOTES_SQL = "notes AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in NOTE_COLUMNS.items()) + " FROM documents" + "".join(f" UNION ALL SELECT CAST({r[0]} AS BIGINT), {r[1]}, {r[2]}, {r[3]}, {r[4]}" for r in _EXTRA) + ")"

#: Documents with every kind of defect, by rules on the id.
DEFECT_TEXT = (
    "CASE doc_id % 12"
    " WHEN 0 THEN 'םולש ךלמ' || chr(10) || 'שלום עולם אבג' || chr(10) || 'םולש' || chr(10) || text"
    " WHEN 1 THEN '.a line' || chr(10) || 'b )c(' || chr(10) || 'on 51-10-4202 and 15-01-2024' || chr(10) || 'x' || chr(10) || 'y' || chr(10) || text"
    " WHEN 2 THEN '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| c | d | e |' || chr(10) || '| 12 | ff |' || chr(10) || text"
    " WHEN 3 THEN '<!-- image -->' || chr(10) || text || chr(10) || '![x]( ) and ![y](pics/a.png) ![z](http://h/x.png)'"
    " WHEN 4 THEN 'data:image/png;base64,iVBORw0KGgoAAAANSUhEUgAAAAEAAAABCAYAAAAfFcSJ. ' || text"
    " WHEN 5 THEN ', goes on' || chr(10) || text"
    " WHEN 6 THEN '---' || chr(10) || 'title: x' || chr(10) || '---' || chr(10) || text"
    " WHEN 7 THEN '# Head' || chr(10) || text"
    " WHEN 8 THEN text || chr(10) || repeat('QUJD', 140) || ' end'"
    " WHEN 9 THEN text || '\u200e\u202e' || chr(1)"
    " WHEN 10 THEN '```' || chr(10) || '<!-- image -->' || chr(10) || '```' || chr(10) || text"
    " ELSE text END"
)




def _raw(blob, text: str) -> str:  # noqa: ANN001
    """Bytes of the files: those of the text, with NULs, bytes that are no UTF-8, and the leading bytes of other types."""
    parts = {11: (text, blob("000041")), 20: (blob("504B0304"), text), 23: (blob("504B0304" + b"[Content_Types].xml".hex().upper()), text), 14: (text, blob("FF")), 15: (blob("89504E470D0A1A0A"), text), 16: (blob("1F8B08"), text), 17: (blob("524946460000000057415645"), text), 18: (blob("255044462D"), text)}
    return "CASE doc_id % 24 " + " ".join(f"WHEN {k} THEN {a} || {b}" for k, (a, b) in parts.items()) + f" ELSE {text} END"


def defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", f"{DEFECT_TEXT} AS text")
    return docs.selectExpr("doc_id", "text", f"{_raw(lambda h: f"X'{h}'", 'CAST(text AS BINARY)')} AS raw", "'docs/d' || CAST(doc_id % 3 AS STRING) || '/' || CAST(doc_id AS STRING) || '.md' AS path")


DEFECTS_SQL = f"docs_t AS (SELECT doc_id, {DEFECT_TEXT} AS text FROM documents), docs AS (SELECT doc_id, text, {_raw(lambda h: f"unhex('{h}')", 'encode(text)')} AS raw FROM docs_t)"


def content_lines_sql(table: str, key: str) -> str:
    """Content lines of a table's text in DuckDB: cl(key, line_no, line) without frontmatter and fences."""
    return f"""
    cl_s AS (SELECT {key} AS key, string_split_regex(text, '\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x{{85}}\\x{{2028}}\\x{{2029}}]') AS ls FROM {table}),
    cl_t AS (SELECT key, CASE WHEN ls[-1] = '' THEN ls[:-2] ELSE ls END AS ls FROM cl_s),
    cl_l AS (SELECT key, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS line_no FROM cl_t),
    cl_f AS (SELECT key, min(line_no) FILTER (WHERE line_no > 1 AND trim(line) = '---') AS shut, bool_or(line_no = 1 AND trim(line) = '---') AS opens FROM cl_l GROUP BY key),
    cl_g AS (SELECT cl_l.key, line, line_no, regexp_matches(line, '^\\s*(```|~~~)') AS fence FROM cl_l JOIN cl_f USING (key) WHERE NOT opens OR shut IS NULL OR line_no > shut),
    cl_h AS (SELECT key, line, line_no, fence, sum(CASE WHEN fence THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY line_no) AS n FROM cl_g),
    cl AS (SELECT key, line_no, line FROM cl_h WHERE NOT fence AND n % 2 = 0)"""
