"""Scalar text functions as column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that don't count as evidence when answers are graded.
STOPWORDS = "the a an and or of to in is it for that this with as at by on from be are was were than then its per also not but into each what".split()
#: Phrases by which an answer says that something isn't covered.
REFUSALS = [
    "not covered", "does not cover", "doesn't cover", "not in this vault",
    "no note", "no notes", "not present", "absent", "does not appear",
    "doesn't appear", "nothing in this vault", "not indexed", "no coverage",
    "not found in the vault", "no source in this vault",
]


def slugify(x: Column) -> Column:
    """lower-case words joined by dashes; whatever isn't a-z or 0-9 is a dash."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(x)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug_title(slug: Column) -> Column:
    """a slug as a title."""
    return F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))


def stripped(x: Column) -> Column:
    """White space off both ends, any kind of it."""
    return F.regexp_replace(x, "(?U)^\\s+|\\s+$", "")


def tokens(x: Column) -> Column:
    """runs of letters, digits and underscores, lower-cased; of any script."""
    return F.regexp_extract_all(F.lower(x), F.lit("[\\p{L}\\p{N}_]+"), F.lit(0))


def token_estimate(x: Column) -> Column:
    """a quarter of the characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(x) / 4).cast("int"))


def answer_tokens(x: Column) -> Column:
    """F16: distinct evidence words of an answer: longer than 2 and no stop words."""
    found = F.regexp_extract_all(F.lower(x), F.lit("[a-z0-9][a-z0-9\\-]*"), F.lit(0))
    return F.array_distinct(F.filter(found, lambda w: (F.length(w) > 2) & ~w.isin(STOPWORDS)))


def overlap_percent(gold: Column, answer: Column) -> Column:
    """F16: percentage of the gold text's evidence words that the answer has, rounded half to even; 0 without gold words."""
    g, a = answer_tokens(gold), answer_tokens(answer)
    return F.when(F.size(g) == 0, F.lit(0.0)).otherwise(F.bround(100.0 * F.size(F.array_intersect(g, a)) / F.size(g)))


def cites(answer: Column, stem: Column) -> Column:
    """is the note named, as a link, a file or plainly."""
    return F.contains(F.lower(answer), F.lower(stem))


def is_refusal(answer: Column) -> Column:
    """does the answer say that the corpus has nothing on it."""
    low = F.lower(answer)
    found = F.lit(False)
    for marker in REFUSALS:
        found = found | F.contains(low, F.lit(marker))
    return found


def yaml_quoted(x: Column) -> Column:
    """a string as a double-quoted YAML scalar."""
    out = F.replace(x, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(raw), F.lit(shown))
    return F.concat(F.lit('"'), out, F.lit('"'))


def diagram_label(x: Column, longest: int) -> Column:
    """a label that is safe inside a diagram: no quotes, brackets, braces, pipes or line ends, cut with an ellipsis."""
    flat = F.trim(F.regexp_replace(F.replace(x, F.lit('"'), F.lit("'")), "\r\n|\r|\n", " "))
    cut = F.when(F.length(flat) > longest, F.concat(F.substring(flat, 1, longest - 1), F.lit("…"))).otherwise(flat)
    return F.translate(cut, "[]{}|", "()()/")


def pdf_date(x: Column) -> Column:
    """D:YYYYMMDDhhmmss as a UTC timestamp; null if it isn't one."""
    return F.try_to_timestamp(F.regexp_extract(x, "D:(\\d{14})", 1), F.lit("yyyyMMddHHmmss"))


def file_version(x: Column) -> Column:
    """the value of a ``version:`` line, else 1."""
    found = F.regexp_extract(x, "(?m)^version:\\s*(\\S+)", 1)
    return F.when(found == "", F.lit("1")).otherwise(found)


def char_tokens(x: Column) -> Column:
    """slices of four characters."""
    return F.regexp_extract_all(x, F.lit("(?s).{1,4}"), F.lit(0))


def mirrored_path(x: Column) -> Column:
    """The markdown path of a raw file."""
    return F.regexp_replace(x, "\\.[^./]+$", ".md")


def store_path(text: Column) -> Column:
    """Content address of a chunk, ``store/ab/<hash>.md``."""
    digest = F.sha2(text.cast("binary"), 256)
    return F.concat(F.lit("store/"), F.substring(digest, 1, 2), F.lit("/"), digest, F.lit(".md"))


def payload_path(x: Column) -> Column:
    """a leading dot folder as it is packaged, ``.name/`` as ``dot-name/``."""
    return F.regexp_replace(x, "^\\.([^./]+)/", "dot-$1/")


def embed_text(title: Column, body: Column) -> Column:
    """what is embedded of a document."""
    return F.concat_ws("\n", F.nullif(title, F.lit("")), body)


def email_header(subject: Column, sender: Column, to: Column, date: Column) -> Column:
    """the header block in front of a mail's text."""
    parts = [F.concat(F.lit(f"{name}: "), F.coalesce(x, F.lit(""))) for name, x in (("Subject", subject), ("From", sender), ("To", to), ("Date", date))]
    return F.concat_ws("\n", *parts)


def safe_attachment(x: Column) -> Column:
    """base name of an attachment; names that are none become attachment.md."""
    base = F.regexp_extract(F.replace(x, F.lit("\\"), F.lit("/")), "[^/]*$", 0)
    return F.when(base.isin("", ".", ".."), F.lit("attachment.md")).otherwise(base)


def markdown_html(body: Column) -> Column:
    """a small HTML rendering of markdown; the order of the steps matters."""
    x = body
    for raw, shown in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(raw), F.lit(shown))
    for n in (3, 2, 1):
        x = F.regexp_replace(x, f"(?m)^{'#' * n} (.+)$", f"<h{n}>$1</h{n}>")
    x = F.regexp_replace(x, "\\*\\*(.+?)\\*\\*", "<strong>$1</strong>")
    x = F.regexp_replace(x, "(?s)```(.*?)```", "<pre>$1</pre>")
    return F.concat(F.lit("<p>"), F.regexp_replace(x, "\n\n+", "</p><p>"), F.lit("</p>"))


def html_title(html: Column) -> Column:
    """the title element's text, stripped; empty if there is none."""
    return stripped(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1))


def html_text(html: Column) -> Column:
    """F31, a subset of our own: no scripts, styles, navigation, comments or tags; the common references decoded; white space squeezed."""
    x = F.regexp_replace(html, "(?is)<(script|style|nav)\\b[^>]*>.*?</\\1>|<!--.*?-->", " ")
    x = F.regexp_replace(x, "<[^>]*>", " ")
    for raw, shown in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = F.replace(x, F.lit(raw), F.lit(shown))
    return F.trim(F.regexp_replace(x, "\\s+", " "))


def expansion_lines(text: Column, query: Column) -> Column:
    """F32: (kind, text) of the lines ``lex|vec|hyde: text`` that share a word with the query; three made-up ones if none does."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.struct(F.lower(F.regexp_extract(x, "^\\s*(lex|vec|hyde)\\s*:\\s*(.+?)\\s*$", 1)).alias("kind"), F.regexp_extract(x, "^\\s*(lex|vec|hyde)\\s*:\\s*(.+?)\\s*$", 2).alias("text")))
    kept = F.filter(lines, lambda x: (x["kind"] != "") & F.arrays_overlap(tokens(x["text"]), tokens(query)))
    made = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("text")) for k, v in (("hyde", F.concat(F.lit("Information about "), query)), ("lex", query), ("vec", query))])
    return F.when(F.size(kept) > 0, kept).otherwise(made)


def rerank_score(yes: Column, no: Column, text: Column) -> Column:
    """share of yes from two log-probabilities (missing: -100); without both, 1 if the text starts with yes."""
    y, n = F.exp(F.coalesce(yes, F.lit(-100.0))), F.exp(F.coalesce(no, F.lit(-100.0)))
    said = F.when(F.lower(F.trim(text)).startswith("yes"), F.lit(1.0)).otherwise(0.0)
    return F.when(yes.isNull() & no.isNull(), said).otherwise(y / (y + n))
