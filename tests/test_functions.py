"""Literal fixtures for functions and operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillspark.functions import markdown as M
from quillspark.functions import text as X
from quillspark.operators import campaign, chunking, classify, conversion, detectors, filters, graph, hebrew, ledger, repair, retrieval, translation, vault
from quillspark.sources import config


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "slug"), [("Über 90% of it (v2.0)", "ber-90-of-it-v2-0"), ("--x--", "x"), ("\t Two\nlines ", "two-lines"), ("éé", ""), ("", "")])
def test_slugify(spark, raw, slug):
    assert one(spark, X.slugify(F.lit(raw))) == slug


def test_frontmatter(spark):
    text = '---\nname: "Tidal charts"\nkeeper: Harbour\nports:\n- north\n  - "south"\ninline: [p, q]\nscalar: z\n- lost\n---\nHigh water at six\n'
    got = one(spark, M.frontmatter(F.lit(text)))
    assert got == {"name": ["Tidal charts"], "keeper": ["Harbour"], "ports": ["north", "south"], "inline": ["[p, q]"], "scalar": ["z"]}
    assert one(spark, M.body(F.lit(text))).startswith("High water at six")
    for plain in ("without any", "---\na: 1\nnever closed"):
        assert one(spark, M.frontmatter(F.lit(plain))) == {}
    assert one(spark, M.body(F.lit("without any"))) == "without any"


def test_wikilinks(spark):
    assert one(spark, M.wikilinks(F.lit("[[a]] ![[b|x]] [[ c #d]] [[e|f]] [f]"))) == ["a", "b", "c", "e"]


def test_user_zone(spark):
    assert one(spark, M.user_zone(F.lit("x<a>mine<b>y"), "<a>", "<b>")) == "mine"
    assert one(spark, M.user_zone(F.lit("x<b>mine<a>y"), "<a>", "<b>")) is None
    assert one(spark, M.user_zone(F.lit("nothing"), "<a>", "<b>")) is None


def test_headers_skip_fences(spark):
    text = "intro\n## Tides\n```\n# in code\n```\n  ### Moons\ntext # no heading\n```\n# unclosed"
    assert one(spark, chunking.headers(F.lit(text))) == "## Tides\n  ### Moons"


def test_first_window(spark):
    body = "# Tides\n" + "ebb and flow. " * 200 + "\n# Moons\n" + "waxing " * 90
    chunk = one(spark, chunking.first_window(F.lit(body), 300))
    text, _, outline = chunk.partition("\n\n## Outline\n")
    assert outline == "# Tides\n# Moons" and body.startswith(text) and text.endswith("flow.") and len(chunk) <= 4 * 300 + len("\n\n## Outline\n")
    with pytest.raises(ValueError):
        chunking.check_window(199)


@pytest.mark.parametrize(("pages", "plan"), [(1, [1]), (99, [99]), (100, [100]), (150, [50, 50, 50]), (163, [50, 50, 50, 13])])
def test_page_plan(spark, pages, plan):
    assert one(spark, chunking.page_plan(F.lit(pages))) == plan


def test_verdicts(spark):
    tax = ["a", "b"]
    cases = {
        "{bad": "bad_json",
        '{"confidence": 0.73}': "numeric_confidence",
        '{"confidence": true}': "numeric_confidence",
        '{"confidence_bucket": "X"}': "bad_bucket",
        '{"confidence_bucket": "SURE", "relation_type": "x"}': "bad_relation",
        '{"confidence_bucket": "SURE", "reasoning_brief": " "}': "no_reasoning",
        '{"confidence_bucket": "SURE", "reasoning_brief": "r", "primary_subdomain": "z"}': "bad_primary",
        '{"confidence_bucket": "SURE", "reasoning_brief": "r", "primary_subdomain": "a", "secondary_subdomains": ["z"]}': "bad_secondary",
        '{"confidence_bucket": "SURE", "reasoning_brief": "r", "primary_subdomain": "a", "secondary_subdomains": ["b"]}': None,
    }
    df = spark.createDataFrame(list(cases.items()), "json string, want string")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", classify.reject_reason(F.col("json"), tax)).collect())
    assert list(classify.verdict_schema(tax)["properties"])[0] == "reasoning_brief"
    assert all(f'value="{c}"' in classify.label_view(tax) for c in tax)


def test_hebrew(spark):
    d = hebrew.counts(spark.createDataFrame([("אבג דאה אבג",)], "t string"), "t")
    assert {(r["kind"], r["item"]): r["n"] for r in d.collect()} == {("word", "אבג"): 2, ("word", "דאה"): 1, ("phrase", "אבג דאה"): 1, ("phrase", "דאה אבג"): 1, ("phrase", "אבג דאה אבג"): 1}
    counts = spark.createDataFrame([("word", "שלום", 50), ("word", "גבא", 100), ("word", "אבג", 1), ("word", "חמש", 100), ("word", "שמח", 60), ("phrase", "גבא דאה", 50)], "kind string, item string, n long")
    words = spark.createDataFrame([("םולש", False), ("אבג", True), ("אבג", False), ("שמח", True)], "word string, ocr boolean")
    got = {(r["word"], r["ocr"]): (r["decision"], r["fixed"]) for r in hebrew.fix_words(words, counts).collect()}
    assert got == {("םולש", False): ("fix", "שלום"), ("אבג", True): ("fix", "גבא"), ("אבג", False): ("keep", "אבג"), ("שמח", True): ("ambiguous", "שמח")}
    docs = spark.createDataFrame([(1, "see דאה גבא here", True), (2, "see דאה גבא here", False), (3, None, True)], "doc_id int, t string, ocr boolean")
    fixed = {r["doc_id"]: r["repair"]["fixed"] for r in hebrew.fix_texts(docs, counts, "t", "ocr").collect()}
    assert fixed == {1: "see גבא דאה here", 2: "see דאה גבא here", 3: None}


def _finding(spark, text, name):
    d = spark.createDataFrame([(1, text, text.encode(), "a/b.md")], "doc_id int, text string, raw binary, path string")
    r = detectors.run(d, [name]).first()
    return r["fired"], r["measures"]


def test_detectors(spark):
    assert _finding(spark, "שלום העולם\n" * 3, "rtl_char_reversed")[0] is False
    assert _finding(spark, "םולש םלועה\n" * 3, "rtl_char_reversed")[0] is True
    assert _finding(spark, "```\n" + "םולש םלועה\n" * 3 + "```", "rtl_char_reversed")[1]["runs_total"] == 0
    fired, m = _finding(spark, ".שלום העולם\n" * 6, "rtl_order_reversed")
    assert fired and m["lines_leading_period"] == 6
    assert _finding(spark, "x 51-10-4202 y\nz\nz\nz\nz", "rtl_order_reversed")[1]["dates_reversed"] == 1
    assert _finding(spark, "x 15-01-2024 y\nz\nz\nz\nz", "rtl_order_reversed")[1]["dates_reversed"] == 0
    good = "| a | b |\n|---|---|\n| long cell | other cell |\n| more text | and more |"
    assert not _finding(spark, good, "table_pipe_inconsistent")[0]
    assert _finding(spark, good + "\n| x | y | z |", "table_pipe_inconsistent")[0]
    assert _finding(spark, "|" + " c |" * 14 + "\n" + "|---" * 14 + "|\n|" + " d |" * 14, "table_shape_implausible")[0]
    assert _finding(spark, "A" * 600, "base64_bare_blob")[0]
    assert not _finding(spark, "A" * 500, "base64_bare_blob")[0]
    assert _finding(spark, ", goes on", "split_opens_midsentence")[0]
    assert not _finding(spark, "---\ntitle: T\n---\ntext", "split_no_title")[0]
    assert _finding(spark, "%PDF-1.4", "binary_magic_bytes")[0]
    assert _finding(spark, "", "split_no_title")[0]
    with pytest.raises(ValueError):
        detectors.register("split_no_title", "none", dict)(lambda v, t: None)


def test_census_has_all_detectors(spark, sf_dir):
    rows = [(1, "short ![a](gone.png)"), (2, "x" * 300 + " ![a](there.png)"), (3, "y" * 300)]
    d = spark.createDataFrame([(i, t, t.encode(), f"a/{i}.md") for i, t in rows], "doc_id int, text string, raw binary, path string")
    found = detectors.census(d, spark.createDataFrame([("a/there.png",)], "path string")).collect()
    assert len(found) == 3 * 16 and len({r["detector"] for r in found}) == 16
    fired = {(r["doc_id"], r["detector"]) for r in found if r["fired"]}
    assert {x for x in fired if x[1] in ("image_broken_ref", "split_length_outlier")} == {(1, "image_broken_ref"), (1, "split_length_outlier")}

    from quillspark.plans import registry

    q = registry.queries()
    counts = {r["detector"]: r["fired"] for r in q["census_fire_counts"](spark, sf_dir).collect()}
    assert len(counts) == 16
    assert counts["image_broken_ref"] == q["det_image_broken_ref"](spark, sf_dir).where("broken_count > 0").count()
    assert counts["split_length_outlier"] == q["det_split_length_outlier"](spark, sf_dir).where("fired").count()


def test_repair_is_checked(spark):
    d = spark.createDataFrame([(1, "םולש and [[םולש]]", b"", "a.md")], "doc_id int, text string, raw binary, path string")
    r = repair.reverse_runs(d).first()
    assert r["repaired"] == "שלום and [[םולש]]" and r["healed"]


def test_ledger(spark):
    e = spark.createDataFrame([(1, "a", "new"), (2, None, "x"), (3, "a", "done"), (4, "b", "in_flight")], "seq int, doc string, status string")
    assert {(r["key"], r["status"]) for r in ledger.project(e, "doc", "seq").collect()} == {("a", "done"), ("_global", "x"), ("b", "in_flight")}
    assert [r["key"] for r in ledger.poisoned(e, "doc", "seq", "status").collect()] == ["b"]


def test_graph(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 5), (6, 6)], "src long, dst long")
    assert {(r["node"], r["depth"]) for r in graph.reachable(e, [1]).collect()} == {(1, 0), (2, 1), (3, 2)}
    assert graph.shortest_path(e, 1, 3) == 2 and graph.shortest_path(e, 1, 5) is None
    assert {(r["node"], r["component"]) for r in graph.components(e).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6)}
    tree = spark.createDataFrame([(1, None, 0), (2, 1, 1), (3, 1, 0), (4, 3, 0)], "id int, parent int, ord int")
    assert [r["id"] for r in graph.flatten_tree(tree).orderBy("order").collect()] == [1, 3, 4, 2]
    levels = graph.topological_levels(spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "item int"), spark.createDataFrame([(2, 1), (3, 2), (4, 4)], "item int, needed int"))
    assert {(r["item"], r["level"]) for r in levels.collect()} == {(1, 0), (2, 1), (3, 2), (4, None)}


def test_betweenness(spark):
    path = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5)], "src long, dst long")
    assert {r["node"]: r["betweenness"] for r in graph.betweenness(path).collect()} == {1: 0, 2: 3, 3: 4, 4: 3, 5: 0}
    square = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "a")], "src string, dst string")
    assert {r["betweenness"] for r in graph.betweenness(square).collect()} == {0.5}


def test_template_similarity(spark):
    assert one(spark, filters.template_similarity(F.lit("Owner: Date: Purpose: fill in here"), ["owner date purpose fill in here"])) == 1.0
    assert one(spark, filters.template_similarity(F.lit("nothing alike at all"), ["owner date purpose"])) == 0.0


def test_filters(spark):
    assert one(spark, filters.fenced_only(F.lit("```json\n{}\n```")))
    assert not one(spark, filters.fenced_only(F.lit("```json\n{}\n```\ntext")))
    assert one(spark, filters.attachment_stub(F.lit("see attachment report.pdf")))
    assert one(spark, filters.bare_length(F.lit("[a](b) # *x*"))) == 1
    x = spark.createDataFrame([("<a><b/></a>",), ("<a>",), (None,), ("text",)], "t string")
    assert [r["is_xml"] for r in filters.with_xml_flag(x, "t").collect()] == [True, False, False, False]
    assert one(spark, filters.routing(F.lit("gate"), F.lit("in"), F.lit(True))) == "accept"


def test_translation(spark):
    p = spark.createDataFrame([(1, "# A\nx 5", "# A\ny 5"), (2, "# A\nx 5", "## A\ny 6")], "doc_id int, source string, target string")
    assert {r["doc_id"]: r["failed"] for r in translation.quarantined(p).collect()} == {1: [], 2: ["heading_fidelity", "numeric_fidelity"]}
    g = spark.createDataFrame([("x", "y")], "term string, english string")
    assert {(r["doc_id"], r["wanted"], r["found"]) for r in translation.retention(p, g).collect()} == {(1, 1, 1), (2, 1, 1)}
    assert one(spark, translation.paragraph_chunks(F.lit("aa\n\nbb\n\n# h\n\ncc"), 6)) == ["aa\n\nbb", "# h", "cc"]


def test_conversion(spark):
    mail = b"Subject: =?utf-8?b?16nXnNeV150=?=\r\nFrom: a@x\r\nTo: b@y\r\nDate: Mon, 6 Jan 2020 10:00:00 +0200\r\n\r\nhello"
    r = conversion.parse_mail(spark.createDataFrame([(mail,)], "raw binary")).first()
    assert r["mail"]["subject"] == "שלום" and str(r["mail"]["created"]) == "2020-01-06 08:00:00"
    assert r["markdown"].startswith("Subject: שלום\nFrom: a@x\nTo: b@y\nDate: Mon")
    f = spark.createDataFrame([("raw/n/a.one",), ("raw/m/b.one",)], "path string")
    n = spark.createDataFrame([("raw/n",)], "folder string")
    assert [tuple(x) for x in conversion.subsumed(f, n).collect()] == [("raw/n/a.one", "raw/n")]
    assert one(spark, conversion.created(F.lit(None).cast("timestamp"), F.expr("current_timestamp() - INTERVAL 1 HOUR"), F.current_timestamp())) is None


def test_retrieval(spark):
    pairs = spark.createDataFrame([("a",), ("a",), ("b",)], "t string")
    seen = []

    def score(texts):
        seen.append(texts.count())
        return texts.withColumn("s", F.length("t"))

    assert retrieval.rerank_once(pairs, "t", score).count() == 3 and seen == [2]
    v = spark.createDataFrame([(1, [1.0, 0.0])], "id int, v array<double>")
    with pytest.raises(Exception, match="dimension"):
        v.select(retrieval.checked_dim(F.col("v"), 3)).collect()


def test_vault(spark):
    c = spark.createDataFrame([("n", "---\ntitle: Understanding Low-Rank Adapters\nauthor: A\n---\nx")], "stem string, text string")
    none = spark.createDataFrame([], "slug string")
    first = vault.ingest(c, none, "2026-01-01")
    assert first.first()["slug"] == "understanding-low-rank-adapters"
    assert vault.ingest(c, first.select("slug"), "2026-01-01").count() == 0
    text = one(spark, vault.accepted_text(F.lit("---\ntitle: T\n---\nbody"), F.lit("a"), F.array(F.lit("b")), F.lit("high")))
    assert text == '---\ntitle: T\ndomains:\n  - a\n  - b\ndoc_decision: a\ndecided_by: model\ndoc_type: classified\ntrust: high\nlevel: "1"\n---\n\nbody'


def test_config(spark):
    assert config.merged({"pdf": {"a": 1, "b": 2}, "x": 1}, {"pdf": {"b": 3}, "y": 2}) == {"pdf": {"a": 1, "b": 3}, "x": 1, "y": 2}
    t = 'version: 1\nsubdomains:\n  alpha:\n    definition: "A"\n    examples:\n      - text: "one"\n  beta:\n    definition: B\n'
    assert [(r["name"], r["definition"], r["examples"]) for r in config.taxonomy(spark, t).orderBy("ord").collect()] == [("alpha", "A", ["one"]), ("beta", "B", [])]
    with pytest.raises(ValueError):
        campaign.freeze(["a"], {})
