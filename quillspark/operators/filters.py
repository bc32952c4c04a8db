"""Entry filters: gates reject by themselves, evidence is only measured. Formulas and thresholds are ours where the design leaves them open."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.markdown import body, lines
from quillspark.functions.shipping import ship
from quillspark.functions.text import stripped
from quillspark.functions.binding import let

#: Ours: floors and thresholds; a campaign may override them.
THRESHOLDS = {"guid_filename_coverage": 0.80, "thin_body": 40, "empty_shell": 20, "audit_percent": 5}
GUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
FILENAME = "[\\w.-]+\\.(?:pdf|docx?|xlsx?|pptx?|png|jpe?g|gif|zip|txt|csv|html?)\\b"


def is_json(text: Column) -> Column:
    """Does the whole body parse as a JSON object or array."""
    return F.coalesce(F.try_parse_json(text).isNotNull() & text.rlike("^\\s*[\\[{]"), F.lit(False))


def with_xml_flag(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``is_xml``, whether the whole text is well-formed XML. Arrow batches; texts that don't start with < aren't parsed."""
    ship(docs.sparkSession)

    @F.pandas_udf("boolean")
    def parses(x):  # noqa: ANN001, ANN202
        from xml.parsers import expat

        def one(t: str | None) -> bool:
            if not t or not t.lstrip().startswith("<"):
                return False
            p = expat.ParserCreate()
            p.EntityDeclHandler = lambda *a: (_ for _ in ()).throw(ValueError("entities are refused"))
            try:
                p.Parse(t.strip(), True)
            except (expat.ExpatError, ValueError):
                return False
            return True

        return x.map(one)

    return docs.withColumn("is_xml", F.coalesce(parses(F.col(text)), F.lit(False)))


def fenced_only(text: Column) -> Column:
    """One JSON or XML fence and nothing else."""
    return F.trim(text).rlike("(?s)^```(json|xml)\\b(?:(?!```).)*```$")


def span_coverage(text: Column) -> Column:
    """Share of the characters other than white space in GUIDs and file names, overlaps counted once.

    A GUID has no dot and only characters of file names, so where both overlap it lies
    inside the name; trying the name first at every place gives the union of the spans.
    """
    dense = F.length(F.regexp_replace(text, "(?U)\\s", ""))
    left = F.length(F.regexp_replace(F.regexp_replace(text, f"{FILENAME}|{GUID}", ""), "(?U)\\s", ""))
    return F.when(dense > 0, F.round((dense - left) / dense, 4)).otherwise(0.0)


def uuid_title_thin_body(title: Column, text: Column) -> Column:
    """G7."""
    return title.rlike(f"^{GUID}$") & (F.length(stripped(text)) < THRESHOLDS["thin_body"])


def bare_length(text: Column) -> Column:
    """Characters that are left without markup and links."""
    x = F.regexp_replace(text, "!?\\[[^\\]]*\\]\\([^)]*\\)|<[^>]*>|https?://\\S+|[#*_`>|~-]", "")
    return F.length(F.regexp_replace(x, "(?U)\\s+", ""))


def attachment_stub(text: Column) -> Column:
    """G9."""
    return F.trim(F.lower(text)).rlike(f"^(please\\s+)?see\\s+(the\\s+)?attach(ed|ment)[^\\n]{{0,20}}\\s*({FILENAME})?\\.?$")


def char_share(text: Column, keep: str) -> Column:
    """G10 and the like: share of characters of a class."""
    return F.when(F.length(text) > 0, F.round(F.regexp_count(text, F.lit(f"[{keep}]")) / F.length(text), 4)).otherwise(0.0)


def line_share(text: Column, test) -> Column:
    share = lambda ls: F.when(F.size(ls) > 0, F.round(F.size(F.filter(ls, test)) / F.size(ls), 4)).otherwise(0.0)
    return let(F.filter(lines(text), lambda x: x.rlike("(?U)\\S")), share)


def measures(text: Column) -> dict[str, Column]:
    """Evidence G10-G19 of a body; none of it decides."""
    links = F.regexp_count(text, F.lit("\\[[^\\]]*\\]\\([^)]*\\)|https?://"))
    n = F.length(text)
    return {
        "hex_char_ratio": char_share(text, "0-9A-Fa-f"),
        "digit_share": char_share(text, "0-9"),
        "table_row_share": line_share(text, lambda x: F.regexp_count(x, F.lit("\\|")) >= 2),
        "links_per_kchar": F.when(n > 0, F.round(links / n * 1000, 3)).otherwise(0.0),
        "heading_share": line_share(text, lambda x: F.ltrim(x).startswith("#")),
        "macro_count": F.regexp_count(text, F.lit("\\{[a-zA-Z][\\w-]*(:[^}]*)?\\}|<ac:")).cast("double"),
        "mojibake_per_kchar": F.when(n > 0, F.round(F.regexp_count(text, F.lit("\\uFFFD|Ã[\\x{80}-\\x{BF}]|â€")) / n * 1000, 3)).otherwise(0.0),
        "archived": F.substring(text, 1, 200).rlike("(?i)\\b(archived?|deprecated|obsolete)\\b").cast("double"),
        "prose_density": F.when(n > 0, F.round(F.aggregate(F.transform(F.regexp_extract_all(text, F.lit("\\p{Lu}[^.!?\\n]{20,}+[.!?]"), F.lit(0)), lambda s: F.length(s)), F.lit(0), lambda a, x: a + x) / n, 4)).otherwise(0.0),
    }


def template_similarity(text: Column, exemplars: list[str], shingle: int = 3) -> Column:
    """Highest Jaccard coefficient of the text's word shingles with those of the blank templates; 0 without templates."""

    def grams(x: Column) -> Column:
        w = F.regexp_extract_all(F.lower(x), F.lit("[\\p{L}\\p{N}_]+"), F.lit(0))
        return F.when(F.size(w) >= shingle, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - shingle + 1), lambda i: F.xxhash64(F.slice(w, i, shingle))))).otherwise(F.array(F.xxhash64(w)))

    def jaccard(a: Column, b: Column) -> Column:
        n = F.size(F.array_intersect(a, b))
        return n / (F.size(a) + F.size(b) - n)

    if not exemplars:
        return F.lit(0.0)
    return F.round(let(grams(text), lambda g: F.greatest(*[jaccard(g, grams(F.lit(e))) for e in exemplars], F.lit(0.0))), 4)


def gate(text: Column, title: Column, duplicate: Column) -> Column:
    """The first gate that rejects, null if none does; later ones aren't asked."""
    b = body(text)
    return (
        F.when(duplicate, "exact_duplicate")
        .when(is_json(b), "whole_doc_json")
        .when(fenced_only(b), "fenced_data_only")
        .when(span_coverage(b) >= THRESHOLDS["guid_filename_coverage"], "guid_filename_coverage")
        .when(F.coalesce(uuid_title_thin_body(title, b), F.lit(False)), "uuid_title_thin_body")
        .when(attachment_stub(b), "attachment_stub")
        .when(bare_length(b) < THRESHOLDS["empty_shell"], "empty_shell")
    )


def verdict(raw: Column) -> Column:
    """In, out or cant_tell; anything else can't be told."""
    x = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    return F.when(x.isin("in", "out"), x).otherwise("cant_tell")


def routing(gated: Column, judged: Column, protected: Column) -> Column:
    """Accept, reject or expert; the protect list comes first."""
    return F.when(protected, "accept").when(gated.isNotNull(), "reject").when(judged == "in", "accept").when(judged == "out", "reject").otherwise("expert")


def audited(key: Column, percent: int) -> Column:
    """Is a reject in the audit sample, by a hash of its key (a sampling operator)."""
    return F.conv(F.substring(F.sha2(key.cast("string").cast("binary"), 256), 1, 8), 16, 10).cast("long") % 100 < percent


def false_reject_rate(audits: DataFrame) -> DataFrame:
    """Per filter the share of audited rejects that were wrong."""
    return audits.groupBy("filter_id").agg(F.count("*").alias("audited"), F.round(F.avg(F.col("wrong").cast("double")), 4).alias("false_reject_rate"))


def report(decisions: DataFrame) -> DataFrame:
    """Decisions and gates with their counts."""
    return decisions.groupBy("decision", F.coalesce("gate", F.lit("-")).alias("gate")).agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class Filter:
    """A filter by id, lane (gate, evidence or judge) and version; thresholds are looked up by its id."""

    name: str
    lane: str
    version: int = 1


#: The filters in the order in which gates are asked; an id can't be taken twice.
FILTERS: dict[str, Filter] = {}


def register(name: str, lane: str, version: int = 1) -> Filter:
    if name in FILTERS:
        raise ValueError(f"filter {name!r} is registered twice")
    if lane not in ("gate", "evidence", "judge"):
        raise ValueError(f"no such lane: {lane}")
    FILTERS[name] = Filter(name, lane, version)
    return FILTERS[name]


for _name in ("exact_duplicate", "near_duplicate", "whole_doc_json", "whole_doc_xml", "fenced_data_only", "guid_filename_coverage", "uuid_title_thin_body", "attachment_stub", "empty_shell"):
    register(_name, "gate")
for _name in ("hex_char_ratio", "numeric_table_heavy", "nav_page", "toc_page", "template_page", "macro_debris", "rtl_corruption", "encoding_slop", "archive_marker", "prose_density"):
    register(_name, "evidence")
for _name in ("domain_scope", "durable_knowledge"):
    register(_name, "judge")


def thresholds(overrides: dict[str, float] | None = None) -> dict[str, float]:
    """The thresholds with a campaign's own; an unknown name is an error."""
    unknown = set(overrides or ()) - set(THRESHOLDS)
    if unknown:
        raise KeyError(f"no such threshold: {', '.join(sorted(unknown))}")
    return {**THRESHOLDS, **(overrides or {})}


def registry_table(spark: SparkSession) -> DataFrame:
    """(filter, lane, version, ord)."""
    return spark.createDataFrame([(f.name, f.lane, f.version, i) for i, f in enumerate(FILTERS.values())], "filter string, lane string, version int, ord int")


def evidence(text: Column) -> dict[str, Column]:
    """What several measures say together: numeric_table_heavy (digits and table rows), nav_page (links against prose), toc_page (headings against prose)."""
    m = measures(text)
    return {
        "numeric_table_heavy": F.round((m["digit_share"] + m["table_row_share"]) / 2, 4),
        "nav_page": F.round(m["links_per_kchar"] * (1 - m["prose_density"]), 3),
        "toc_page": F.round(m["heading_share"] * (1 - m["prose_density"]), 4),
    }


def rtl_corruption(findings: DataFrame) -> DataFrame:
    """(doc_id, reversed_share, flagged_share, rtl_corruption) from the findings of the two detectors of reversed text; the evidence is the larger share."""
    share = lambda name, key: F.max(F.when(F.col("detector") == name, F.col("measures")[key]))
    both = findings.where(F.col("detector").isin("rtl_char_reversed", "rtl_order_reversed")).groupBy("doc_id").agg(share("rtl_char_reversed", "reversed_share").alias("reversed_share"), share("rtl_order_reversed", "flagged_share").alias("flagged_share"))
    return both.withColumn("rtl_corruption", F.greatest("reversed_share", "flagged_share"))
