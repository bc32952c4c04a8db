"""Conversion-defect detectors and their census.

Each detector maps documents (doc_id, text, raw, path) to findings: doc_id,
detector, route, fired, measures (MAP<STRING, DOUBLE>, whether it fires or not).
All are array functions in the document's own row: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.binding import let
from quillspark.functions.markdown import content, frontmatter
from quillspark.functions.text import stripped

#: Hebrew final letters, and the plain forms of those that have one.
FINALS, TWINS = "ךםןףץ", "כמנפצ"
#: Leading bytes (hex) of file types.
MAGIC = [
    ("526172211A07", "rar"),
    ("504B0304", "zip"),
    ("255044462D", "pdf"),
    ("89504E470D0A1A0A", "png"),
    ("FFD8FF", "jpeg"),
    ("377ABCAF271C", "7z"),
    ("4F676753", "ogg"),
    ("47494638", "gif"),
    ("1F8B", "gzip"),
    ("424D", "bmp"),
]
IMAGE_TYPES = ["png", "jpeg", "gif", "bmp"]
#: Least shares at which a detector fires.
THRESHOLDS = {"rtl_char_reversed": 0.02, "rtl_order_reversed": 0.02, "binary_byte_ratio": 0.02, "table_pipe_inconsistent": 0.10, "table_cell_fragmented": 0.35}

Values = dict[str, Column]


@dataclass(frozen=True)
class Detector:
    """``base`` gives what is worked out of a row, once; ``judge`` the measures and whether it fires, from those values and the threshold."""

    name: str
    route: str
    version: int
    threshold: float
    base: Callable[[], Values]
    judge: Callable[[Values, float], tuple[Values, Column]]


REGISTRY: dict[str, Detector] = {}


def register(name: str, route: str, base: Callable[[], Values], version: int = 1, threshold: float | None = None) -> Callable:
    """A detector by id, route, version and threshold; an id can't be taken twice."""

    def add(judge: Callable[[Values, float], tuple[Values, Column]]) -> Callable:
        if name in REGISTRY:
            raise ValueError(f"detector {name!r} is registered twice")
        REGISTRY[name] = Detector(name, route, version, THRESHOLDS.get(name, 0.0) if threshold is None else threshold, base, judge)
        return judge

    return add


def registry_table(spark: SparkSession) -> DataFrame:
    """(detector, route, version, threshold) in order of the ids."""
    rows = [(d.name, d.route, d.version, float(d.threshold)) for d in (*REGISTRY.values(), *CORPUS_DETECTORS)]
    return spark.createDataFrame(sorted(rows), "detector string, route string, version int, threshold double")


def magic_type(raw: Column) -> Column:
    """Type by leading bytes, null if unknown."""
    head = F.hex(F.substring(raw, 1, 12))
    out = F.when(F.startswith(head, F.lit("52494646")) & (F.substring(head, 17, 8) == "57415645"), "wav")
    for sig, name in MAGIC:
        out = out.when(F.startswith(head, F.lit(sig)), name)
    return out


def prepared(docs: DataFrame) -> DataFrame:
    """Adds what several detectors read: ``__cl``, the content lines (number, line), ``__st``, those that aren't blank, stripped, and ``__blocks``, the table blocks."""
    count = lambda line: F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit("")))
    row = lambda z, i: F.struct(z["n"].alias("n"), z["line"].alias("line"), count(z["line"]).alias("pipes"), i.alias("i"))
    sep = lambda r: F.struct(r["n"].alias("n"), r["line"].alias("line"), r["pipes"].alias("pipes"), r["i"].alias("i"), r["line"].rlike("^\\s*\\|?[\\s:|-]+\\|[\\s:|-]*$").alias("sep"))
    # Rows with pipes, with their places among the content lines; a block starts where the place before isn't the line before.
    piped = F.transform(F.filter(F.transform("__cl", row), lambda r: r["pipes"] >= 2), sep)
    opens = lambda p, z, i: (i == 0) | (F.try_element_at(p, F.when(i > 0, i).otherwise(1))["i"] != z["i"] - 1)
    starts = lambda p: F.filter(F.transform(p, lambda z, i: F.when(opens(p, z, i), i + 1)), lambda x: x.isNotNull())
    ends = lambda p, st, k: F.coalesce(F.try_element_at(st, k + 2), F.size(p) + 1)
    blocks = let(piped, lambda p: let(starts(p), lambda st: F.filter(F.transform(st, lambda s, k: F.slice(p, s, ends(p, st, k) - s)), lambda b: F.size(b) >= 3)))
    solid = F.filter(F.transform("__cl", lambda z: stripped(z["line"])), lambda x: x != "")
    return docs.withColumn("__cl", content(F.coalesce("text", F.lit("")))).withColumn("__st", solid).withColumn("__blocks", blocks)


def _flat(pattern: str, group: int = 0) -> Column:
    return F.flatten(F.transform("__cl", lambda z: F.regexp_extract_all(z["line"], F.lit(pattern), F.lit(group))))


def _share(part: Column, whole: Column, places: int = 4) -> Column:
    return F.when(whole > 0, F.round(part / whole, places)).otherwise(0.0)


def _count(array: Column, test) -> Column:
    return F.size(F.filter(array, test))


def _rtl_runs() -> Values:
    letters = F.filter(F.transform(_flat("[\\u05D0-\\u05EA\\u05B0-\\u05C7\\u05F3\\u05F4]+"), lambda r: F.regexp_replace(r, "[^\\u05D0-\\u05EA]", "")), lambda r: F.length(r) >= 2)
    head = lambda r: F.substring(r, 1, 1).isin(list(FINALS))
    tail = lambda r: F.right(r, F.lit(1)).isin(list(TWINS))
    return {"x": let(letters, lambda z: F.struct(F.size(z).alias("total"), _count(z, lambda r: head(r) | tail(r)).alias("both"), _count(z, head).alias("initial"), _count(z, tail).alias("terminal")))}


@register("rtl_char_reversed", "repair", _rtl_runs)
def _rtl_char(v: Values, least: float):
    total, both = v["x"]["total"], v["x"]["both"]
    m = {"runs_total": total, "runs_reversed": both, "runs_final_initial": v["x"]["initial"], "runs_nonfinal_terminal": v["x"]["terminal"], "reversed_share": _share(both, total)}
    return m, (total >= 5) & (F.when(total > 0, both / total).otherwise(0.0) >= least)


def _order_marks() -> Values:
    period = lambda x: x.startswith(".")
    mirrored = lambda x: (F.instr(x, ")") > 0) & ((F.instr(x, "(") == 0) | (F.instr(x, ")") < F.instr(x, "(")))
    dates = lambda x: _count(F.regexp_extract_all(x, F.lit("\\b\\d{2}-\\d{2}-\\d{4}\\b"), F.lit(0)), lambda t: F.try_to_timestamp(F.reverse(t), F.lit("yyyy-MM-dd")).isNotNull())
    marks = F.transform("__st", lambda x: F.struct(period(x).alias("period"), mirrored(x).alias("mirrored"), dates(x).alias("dates")))
    per = lambda z: F.struct(F.size(z).alias("total"), _count(z, lambda x: x["period"] | x["mirrored"] | (x["dates"] > 0)).alias("flagged"), _count(z, lambda x: x["period"]).alias("period"), _count(z, lambda x: x["mirrored"]).alias("mirrored"), F.aggregate(z, F.lit(0), lambda a, x: a + x["dates"]).alias("dates"))
    return {"x": let(marks, per)}


@register("rtl_order_reversed", "repair", _order_marks)
def _rtl_order(v: Values, least: float):
    total, flagged = v["x"]["total"], v["x"]["flagged"]
    m = {"lines_total": total, "lines_flagged": flagged, "lines_leading_period": v["x"]["period"], "lines_mirrored_parens": v["x"]["mirrored"], "dates_reversed": v["x"]["dates"], "flagged_share": _share(flagged, total)}
    return m, (total >= 5) & (F.when(total > 0, flagged / total).otherwise(0.0) >= least)


@register("rtl_bidi_controls", "none", lambda: {"n": F.regexp_count(F.coalesce("text", F.lit("")), F.lit("[\\u200E\\u200F\\u202A-\\u202E\\u2066-\\u2069]")), "chars": F.length(F.coalesce("text", F.lit("")))})
def _bidi(v: Values, least: float):
    return {"control_count": v["n"], "controls_per_kchar": F.when(v["chars"] > 0, F.round(v["n"] / v["chars"] * 1000, 3)).otherwise(0.0)}, v["n"] > 0


def _leading() -> Values:
    kind = magic_type(F.col("raw"))
    # Only a zip's first bytes are looked through for the part that tells an office file.
    ooxml = F.when(kind == "zip", F.instr(F.hex(F.substring(F.col("raw"), 1, 4096)), "5B436F6E74656E745F54797065735D2E786D6C") > 0)
    return {"kind": kind, "ooxml": F.coalesce(ooxml, F.lit(False))}


@register("binary_magic_bytes", "reroute", _leading)
def _magic(v: Values, least: float):
    return {"recognised": v["kind"].isNotNull().cast("int"), "ooxml": v["ooxml"].cast("int"), "byte_size": F.octet_length("raw")}, v["kind"].isNotNull()


def _byte_counts() -> Values:
    ok = F.coalesce(F.is_valid_utf8(F.col("raw").cast("string")), F.lit(True))
    text = F.coalesce("text", F.lit(""))
    nul = F.octet_length("raw") - F.octet_length(F.replace(F.col("raw").cast("string"), F.lit("\0"), F.lit("")))
    return {"ok": ok, "nul": F.coalesce(nul, F.lit(0)), "controls": F.when(ok, F.regexp_count(text, F.lit("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]"))).otherwise(0), "chars": F.length(text)}


@register("binary_byte_ratio", "reroute", _byte_counts)
def _bytes(v: Values, least: float):
    share = F.when(v["chars"] > 0, v["controls"] / v["chars"]).otherwise(0.0)
    return {"nul_bytes": v["nul"], "decodable": v["ok"].cast("int"), "control_chars": v["controls"], "control_share": F.round(share, 4)}, (v["nul"] > 0) | ~v["ok"] | (share >= least)


_URI = "data:([\\w.+-]+/[\\w.+-]+);base64,([A-Za-z0-9+/=\\s]{40,})"


def decoded(payload: Column) -> Column:
    """Strict base64 without white space; null if it isn't."""
    dense = F.regexp_replace(payload, "\\s", "")
    return F.when(dense.rlike("^[A-Za-z0-9+/]*={0,2}$") & (F.length(dense) % 4 == 0), F.try_to_binary(dense, F.lit("base64")))


def _blobs(pattern: str, group: int, good: Callable[[Column], Column]) -> Callable[[], Values]:
    def base() -> Values:
        text = F.coalesce("text", F.lit(""))
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        per = lambda z: F.struct(F.size(z).alias("n"), _count(z, good).alias("good"), F.aggregate(z, F.lit(0), lambda a, x: a + F.length(x)).alias("chars"))
        return {"x": let(found, per), "chars": F.length(text)}

    return base


@register("base64_data_uri", "repair", _blobs(_URI, 2, lambda x: F.coalesce(magic_type(decoded(x)).isin(IMAGE_TYPES), F.lit(False))))
def _data_uri(v: Values, least: float):
    return {"blob_count": v["x"]["n"], "decoded_images": v["x"]["good"], "blob_chars": v["x"]["chars"], "blob_share": _share(v["x"]["chars"], v["chars"])}, v["x"]["n"] > 0


@register("base64_bare_blob", "repair", _blobs("(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{512,}={0,2}", 0, lambda x: decoded(x).isNotNull()))
def _bare(v: Values, least: float):
    return {"blob_count": v["x"]["n"], "decodable_blobs": v["x"]["good"], "blob_chars": v["x"]["chars"], "blob_share": _share(v["x"]["chars"], v["chars"])}, v["x"]["n"] > 0


@register("image_placeholder", "reconvert", lambda: {"n": F.size(_flat("<!--\\s*(image|formula-not-decoded)\\s*-->"))})
def _placeholder(v: Values, least: float):
    return {"placeholder_count": v["n"]}, v["n"] > 0


@register("image_empty_target", "reconvert", lambda: {"n": F.size(_flat("!\\[[^\\]]*\\]\\(\\s*\\)"))})
def _empty_target(v: Values, least: float):
    return {"empty_target_count": v["n"]}, v["n"] > 0


def normal_path(x: Column) -> Column:
    """A relative path without . and .. parts."""
    parts = F.filter(F.split(x, "/"), lambda p: (p != "") & (p != "."))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, p: F.when((p == "..") & (F.size(a) > 0) & (F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit("")) != ".."), F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(p))))
    return F.array_join(kept, "/")


def broken_images(docs: DataFrame, files: DataFrame) -> DataFrame:
    """(doc_id, ref_count, broken_count); a reference is broken if no file of the corpus has its resolved path."""
    found = F.filter(F.transform(_flat("!\\[[^\\]]*\\]\\(\\s*([^)\\s]+)", 1), lambda t: F.regexp_replace(t, "^[<>]+|[<>]+$", "")), lambda t: ~t.rlike("(?i)^(https?:|data:|#|mailto:)"))
    base = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    refs = prepared(docs).select("doc_id", base.alias("base"), F.explode_outer(found).alias("t"))
    target = normal_path(F.concat_ws("/", "base", F.coalesce(F.try_url_decode(F.replace("t", F.lit("+"), F.lit("%2B"))), "t")))
    resolved = refs.select("doc_id", F.when(F.col("t").isNotNull(), target).alias("file"))
    there = files.select(F.col("path").alias("file")).distinct().withColumn("there", F.lit(True))
    return resolved.join(there, "file", "left").groupBy("doc_id").agg(F.count("file").alias("ref_count"), F.count_if(F.col("file").isNotNull() & F.col("there").isNull()).alias("broken_count"))


def _modal(counts: Column) -> Column:
    """The most frequent number, the first met on a tie."""
    ranked = F.transform(F.array_distinct(counts), lambda c: F.struct((-_count(counts, lambda x: x == c)).alias("neg"), F.array_position(counts, c).alias("at"), c.alias("c")))
    return F.array_min(ranked)["c"]


def _pipe_counts() -> Values:
    data = F.filter(F.transform("__blocks", lambda b: F.transform(F.filter(b, lambda r: ~r["sep"]), lambda r: r["pipes"])), lambda c: F.size(c) >= 2)
    off = lambda c: let(_modal(c), lambda m: _count(c, lambda x: x != m))
    per = lambda d: F.struct(F.aggregate(d, F.lit(0), lambda a, c: a + F.size(c)).alias("rows"), F.aggregate(F.transform(d, off), F.lit(0), lambda a, x: a + x).alias("off"))
    return {"x": let(data, per)}


@register("table_pipe_inconsistent", "reconvert", _pipe_counts)
def _pipes(v: Values, least: float):
    rows, off = v["x"]["rows"], v["x"]["off"]
    return {"table_rows": rows, "deviating_rows": off, "deviating_share": _share(off, rows)}, (rows >= 3) & (F.when(rows > 0, off / rows).otherwise(0.0) >= least)


def _cells(line: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(stripped(line), "^\\|+|\\|+$", ""), "\\|"), lambda c: stripped(c))


def _cell_counts() -> Values:
    cells = F.filter(F.flatten(F.transform(F.filter(F.flatten(F.col("__blocks")), lambda r: ~r["sep"]), lambda r: _cells(r["line"]))), lambda c: c != "")
    return {"x": let(cells, lambda z: F.struct(F.size(z).alias("total"), _count(z, lambda c: (F.length(c) <= 3) & ~c.rlike("^\\p{N}+$")).alias("bad")))}


@register("table_cell_fragmented", "reconvert", _cell_counts)
def _cells_fragmented(v: Values, least: float):
    total, bad = v["x"]["total"], v["x"]["bad"]
    return {"cells_total": total, "cells_fragmented": bad, "fragmented_share": _share(bad, total)}, (total > 0) & (F.when(total > 0, bad / total).otherwise(0.0) >= least)


def _shapes() -> Values:
    rows = F.transform("__blocks", lambda b: F.transform(F.filter(b, lambda r: ~r["sep"]), lambda r: _cells(r["line"])))
    widest = lambda z: F.coalesce(F.array_max(F.transform(F.flatten(z), lambda c: F.size(c))), F.lit(0))
    blank = lambda z: _count(z, lambda b: (F.size(b) > 0) & F.forall(F.coalesce(F.try_element_at(b, F.lit(1)), F.array(F.lit("x"))), lambda c: c == ""))
    return {"x": let(rows, lambda z: F.struct(F.size(z).alias("n"), widest(z).alias("widest"), blank(z).alias("blank")))}


@register("table_shape_implausible", "reconvert", _shapes)
def _shape(v: Values, least: float):
    return {"table_blocks": v["x"]["n"], "max_columns": v["x"]["widest"], "empty_header_rows": v["x"]["blank"]}, (v["x"]["widest"] > 12) | (v["x"]["blank"] > 0)


#: Sizes are counted in bins of a 64th of their power of two first.
_BINS = 64


def length_percentiles(docs: DataFrame) -> dict[str, int]:
    """A10: nearest-rank percentiles of the byte sizes, in two aggregates: counts of some 2,000 bins at most, then of the sizes in the bins that hold the ranks."""
    z = F.octet_length("raw")
    power = F.when(z > 0, F.floor(F.log2(z))).otherwise(0).cast("int")
    bin_ = (power * _BINS + F.floor((z / F.pow(F.lit(2.0), power) - 1) * _BINS)).cast("int")
    sizes = docs.where(z.isNotNull()).select(z.alias("z"), F.when(z > 0, bin_).otherwise(-1).alias("bin"))
    counts = sorted((r["bin"], r["count"]) for r in sizes.groupBy("bin").count().collect())
    n = sum(c for _, c in counts)
    if not n:
        return {"p05": 0, "p50": 0, "p95": 0}
    places = {}
    for p in ("p05", "p50", "p95"):
        rank = round(int(p[1:]) / 100 * (n - 1))
        for b, c in counts:
            if rank < c:
                places[p] = (b, rank)
                break
            rank -= c
    wanted = sizes.where(F.col("bin").isin([b for b, _ in places.values()])).groupBy("bin", "z").agg(F.count("*").alias("n"))
    running = wanted.withColumn("upto", F.sum("n").over(W.partitionBy("bin").orderBy("z")))
    found = running.agg(*[F.min(F.when((F.col("bin") == b) & (F.col("upto") > rank), F.col("z"))).alias(p) for p, (b, rank) in places.items()]).first()
    return {p: int(found[p]) for p in places}


def length_outliers(docs: DataFrame) -> DataFrame:
    """Shorter than 200 characters, or longer than three times the 95th percentile (of bytes, as defined)."""
    p = length_percentiles(docs)
    n = F.length(F.coalesce("text", F.lit("")))
    short, long = (n < 200).cast("int"), (n > 3.0 * p["p95"]).cast("int")
    m = {"char_count": n, "too_short": short, "extreme_long": long, "corpus_p50": F.lit(p["p50"]), "corpus_p95": F.lit(p["p95"])}
    return _finding(docs, "split_length_outlier", "resplit", m, (short + long) > 0)


@register("split_opens_midsentence", "resplit", lambda: {"first": F.coalesce(F.try_element_at("__st", F.lit(1)), F.lit(""))})
def _midsentence(v: Values, least: float):
    punct, low = v["first"].rlike("^[,;:)\\]}\\u05BE]"), v["first"].rlike("^\\p{Ll}")
    return {"starts_punctuation": punct.cast("int"), "starts_lowercase": low.cast("int")}, punct | low


def _titles() -> Values:
    heading = F.exists(F.slice("__st", 1, 3), lambda x: x.startswith("#"))
    titled = F.coalesce(F.size(F.try_element_at(frontmatter(F.coalesce("text", F.lit(""))), F.lit("title"))) > 0, F.lit(False))
    return {"heading": heading, "titled": titled}


@register("split_no_title", "resplit", _titles)
def _no_title(v: Values, least: float):
    return {"has_heading": v["heading"].cast("int"), "has_frontmatter_title": v["titled"].cast("int")}, ~(v["heading"] | v["titled"])


def _finding(docs: DataFrame, name: str, route: str, measures: dict[str, Column], fired: Column) -> DataFrame:
    pairs = [x for k, v in measures.items() for x in (F.lit(k), v.cast("double"))]
    return docs.select("doc_id", F.lit(name).alias("detector"), F.lit(route).alias("route"), F.coalesce(fired, F.lit(False)).alias("fired"), F.create_map(*pairs).alias("measures"))


#: Detectors that need a join or the whole corpus.
CORPUS_DETECTORS = (
    Detector("image_broken_ref", "reconvert", 1, 0.0, dict, lambda v, t: ({}, F.lit(False))),
    Detector("split_length_outlier", "resplit", 1, 3.0, dict, lambda v, t: ({}, F.lit(False))),
)


def run(docs: DataFrame, names: list[str] | None = None, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Findings of the named detectors (all that read a row alone), in one pass over the documents: a row's findings are an array that is exploded.

    What the detectors share, and what each works out, is a column of its own, so it is
    worked out once a row.  ``thresholds`` override those of the registry.
    """
    used = [REGISTRY[name] for name in sorted(names or REGISTRY)]
    base = prepared(docs)
    worked = base.select("doc_id", "raw", *[F.struct(*[c.alias(k) for k, c in d.base().items()]).alias(f"__{d.name}") for d in used])
    entries = []
    for d in used:
        values = {k: F.col(f"__{d.name}")[k] for k in d.base()}
        measures, fired = d.judge(values, (thresholds or {}).get(d.name, d.threshold))
        pairs = [x for k, v in measures.items() for x in (F.lit(k), v.cast("double"))]
        entries.append(F.struct(F.lit(d.name).alias("detector"), F.lit(d.route).alias("route"), F.coalesce(fired, F.lit(False)).alias("fired"), F.create_map(*pairs).alias("measures")))
    return worked.select("doc_id", F.explode(F.array(*entries)).alias("f")).select("doc_id", "f.*")


def samples(findings: DataFrame, docs: DataFrame, per_finding: int = 3, per_detector: int = 5) -> DataFrame:
    """(detector, doc_id, samples): per detector its first documents that fire, by id, each with its first non-blank content lines, cut to 120 characters.

    The documents are ranked by id alone; only those few rows meet their texts.
    """
    order = W.partitionBy("detector").orderBy("doc_id")
    first = findings.where("fired").select("detector", "doc_id").withColumn("pick", F.row_number().over(order)).where(F.col("pick") <= per_detector).select("detector", "doc_id")
    lines = prepared(docs.join(F.broadcast(first.select("doc_id").distinct()), "doc_id", "left_semi"))
    shown = lines.select("doc_id", F.transform(F.slice("__st", 1, per_finding), lambda x: F.substring(x, 1, 120)).alias("samples"))
    return first.join(F.broadcast(shown), "doc_id").select("detector", "doc_id", "samples")


def census(docs: DataFrame, files: DataFrame) -> DataFrame:
    """Findings of all 16 detectors: those of ``run``, D10 against ``files`` (path) and D14 against the corpus."""
    broken = broken_images(docs, files)
    m = {"ref_count": F.col("ref_count"), "broken_count": F.col("broken_count")}
    return run(docs).union(_finding(broken, "image_broken_ref", "reconvert", m, F.col("broken_count") > 0)).union(length_outliers(docs))


def fire_counts(findings: DataFrame) -> DataFrame:
    """Per detector how many documents fire, and their share."""
    return findings.groupBy("detector").agg(F.count_if("fired").alias("fired"), F.round(F.count_if("fired") / F.count("*"), 4).alias("share"))


def route_totals(findings: DataFrame) -> DataFrame:
    """Distinct documents per route; the route none isn't one."""
    return findings.where("fired AND route <> 'none'").groupBy("route").agg(F.countDistinct("doc_id").alias("docs"))


def cooccurrence(findings: DataFrame, top: int = 25) -> DataFrame:
    """Pairs of detectors that fire on one document. Pairs are made in the document's row: there are 16 detectors."""
    per = findings.where("fired").groupBy("doc_id").agg(F.array_sort(F.collect_set("detector")).alias("d"))
    pairs = F.flatten(F.transform("d", lambda a: F.transform(F.filter("d", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return per.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "a", "b").limit(top)


def accept_reconversion(new: DataFrame, old: DataFrame) -> DataFrame:
    """J17, RA4: (doc_id, accepted): strictly fewer detectors fire than before, and none that didn't."""
    sets = lambda df, name: df.where("fired").groupBy("doc_id").agg(F.collect_set("detector").alias(name))
    empty = F.array().cast("array<string>")
    joined = sets(new, "new").join(sets(old, "old"), "doc_id", "full")
    n, o = F.coalesce("new", empty), F.coalesce("old", empty)
    return joined.select("doc_id", ((F.size(n) < F.size(o)) & (F.size(F.array_except(n, o)) == 0)).alias("accepted"))
