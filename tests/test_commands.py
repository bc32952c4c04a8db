"""Command chains, registries, configuration and outside services."""

from __future__ import annotations

import datetime
import re

import pytest
from pyspark.sql import functions as F

from quillspark.operators import chunking, conversion, filters, graph, hebrew, lint, retrieval, vault
from quillspark.sources import config, converters


def test_convert_goes_by_path_content_and_age(spark):
    early, late = datetime.datetime(2026, 1, 1), datetime.datetime(2026, 1, 2)
    files = [
        ("raw/b.txt", b"same", early), ("raw/a.txt", b"same", early), ("raw/c.csv", b"old", early), ("raw/d.csv", b"newer", late),
        ("raw/n/x.onetoc2", b"same", early), ("raw/n/deep/s.one", b"s", early), ("raw/m/s.one", b"s", early), ("raw/e.xyz", b"?", early), ("raw/f", b"?", early),
        ("raw/g.pdf", b"bad", early), ("raw/h.html", b"<p>", early),
    ]
    existing = [("raw/c.md", late), ("raw/d.md", early)]
    text = lambda raw: F.struct(raw.cast("string").alias("md"), F.when(raw == b"bad", "broken").alias("error"))
    args = (spark.createDataFrame(files, "path string, raw binary, mtime timestamp"), spark.createDataFrame(existing, "path string, mtime timestamp"), {"markitdown": text, "docling": text, "onenote": text})
    got = {r["path"]: (r["status"], r["reason"], r["duplicate_of"], r["converter"], r["md"]) for r in conversion.convert(*args).collect()}
    assert got == {
        "raw/a.txt": ("converted", None, None, "markitdown", "same"),
        "raw/b.txt": ("duplicate", None, "raw/a.txt", None, None),
        "raw/c.csv": ("skipped", "up to date", None, None, None),
        "raw/d.csv": ("converted", None, None, "markitdown", "newer"),
        "raw/n/x.onetoc2": ("converted", None, None, "onenote", "same"),
        "raw/n/deep/s.one": ("skipped", "part of notebook dir (handled via .onetoc2)", None, None, None),
        "raw/m/s.one": ("converted", None, None, "onenote", "s"),
        "raw/e.xyz": ("skipped", "unsupported extension .xyz", None, None, None),
        "raw/f": ("skipped", "unsupported extension ", None, None, None),
        "raw/g.pdf": ("failed", "broken", None, None, None),
        "raw/h.html": ("failed", "no converter", None, None, None),
    }
    forced = {r["path"]: r["status"] for r in conversion.convert(*args, force=True).collect()}
    assert forced["raw/c.csv"] == "converted"


def test_phrase_fixes_with_frequencies_beside_the_document(spark):
    """The joined frequencies give what the whole dictionary gives."""
    texts = ["שלום עולם אבג דאה", "דאה גבא םולש", "גבא דאה עולם שלום", "אבג", "", None, "no Hebrew", "םולש עולם אבג דאה גבא"]
    docs = spark.createDataFrame([(i, t, i % 2 == 0) for i, t in enumerate(texts)], "doc_id long, h string, ocr boolean")
    trusted = spark.createDataFrame([("שלום עולם אבג",)] * 50 + [("גבא דאה",)] * 40 + [("אבג",)], "h string")
    dictionary = hebrew.counts(trusted, "h")
    freq = {(r["kind"], r["item"]): r["freq"] for r in hebrew.frequencies(dictionary).collect()}
    words, phrases = ({i: f for (k, i), f in freq.items() if k == kind} for kind in ("word", "phrase"))
    out = hebrew.fix_texts(docs, dictionary, "h", "ocr").collect()
    assert len(out) == len(texts)
    for r in out:
        want = hebrew._repaired(r["h"], r["ocr"], words, phrases)
        assert (r["repair"]["fixed"], r["repair"]["fixed_words"], r["repair"]["fixed_phrases"], r["repair"]["ambiguous"], r["repair"]["hebrew_fixed"]) == want
    assert any(r["repair"]["fixed_phrases"] for r in out) and any(r["repair"]["fixed_words"] for r in out)


def test_configuration_files():
    text = '# top\nconversion:\n  url: "http://x:1"  # where\n  retries: 3\n  types:\n    - pdf\n    - "do#cx"\nflags: [a, 2, true]\nnothing:\n'
    assert config.parse_yaml(text) == {"conversion": {"url": "http://x:1", "retries": 3, "types": ["pdf", "do#cx"]}, "flags": ["a", 2, True], "nothing": None}
    assert config.load_config(text, {"conversion": {"retries": 1, "wait": 2}})["conversion"]["wait"] == 2
    assert config.load_config('{"a": {"b": 1}}', {"a": {"c": 2}}) == {"a": {"c": 2, "b": 1}}
    for bad in ("a: |\n  x", "a:\n\tb: 1", "- a\n- b", "a:\n  b: 1\n   c: 2", "a:\n- b: 1"):
        with pytest.raises(ValueError, match="line|mapping"):
            config.parse_yaml(bad)
    assert config.campaign_classes("subdomains:\n  one:\n    definition: x\n  two:\n") == ["one", "two"]
    for none in (None, "", "subdomains:\n"):
        with pytest.raises(ValueError, match="taxonomy"):
            config.campaign_classes(none)


def test_outside_services(spark, monkeypatch):
    files = spark.createDataFrame([("a", b"1"), ("b", b"bad"), ("c", None)], "path string, raw binary")

    def run(name, data):
        if data == b"bad":
            raise ValueError("can't read it")
        return f"{name}:{data.decode()}"

    got = {r["path"]: (r["md"], r["error"]) for r in converters.convert_files(files, converters.Converter(run)).collect()}
    assert got == {"a": ("a:1", None), "b": (None, "can't read it"), "c": ("c:", None)}
    with pytest.raises(Exception, match="can't be reached"):
        converters.convert_files(files, converters.Converter(run, healthy=lambda: False)).collect()
    asked = []

    def flaky(name, data):
        asked.append(name)
        raise OSError("gone")

    assert converters.Converter(flaky, attempts=3).one("x", b"") == (None, "gone") and len(asked) == 3
    with pytest.raises(converters.ConverterDown, match="at x"):
        converters.Converter(flaky, healthy=lambda: False).one("x", b"")
    with pytest.raises(KeyError):
        converters.Endpoint.named("QS_TEST_URL")
    monkeypatch.setenv("QS_TEST_URL", "http://h/")
    assert converters.Endpoint.named("QS_TEST_URL").url == "http://h"


def test_check_scaffold_and_register(spark):
    clean = [("_map-of-content", "index/_map-of-content.md", "index", "[[a]] [[c]] [[s]]"), ("log", "index/log.md", "index", "## x | c"), ("a", "wiki/a.md", "wiki", "sources: [[c]]"), ("s", "wiki/sources/s.md", "wiki/sources", "[[a]] [[c]]"), ("c", "raw/c.md", "raw", "text")]
    docs = spark.createDataFrame(clean, "stem string, path string, folder string, text string")
    assert tuple(lint.check(docs, "1", "1").first()) == (0, 0, 5, False, 0)
    assert tuple(lint.check(docs, None, "1").first())[3:] == (False, 0)
    assert tuple(lint.check(docs, "1", "2").first())[3:] == (True, 1)
    todo = docs.union(spark.createDataFrame([("t", "wiki/t.md", "wiki", "sources: [[a]] <!-- TODO")], docs.schema))
    assert lint.check(todo, "1", "1").first()["todos"] == 1
    empty = spark.createDataFrame([], "path string")
    plan = vault.scaffold(spark.createDataFrame([("x",)], "path string"), spark.createDataFrame([("y",)], "path string"), empty)
    assert {tuple(r) for r in plan.collect()} == {("x", "owned"), ("y", "scaffold_only")}
    with pytest.raises(FileExistsError):
        vault.scaffold(empty, empty, spark.createDataFrame([("x",)], "path string"))
    seen = []
    found = vault.register_collections(docs, lambda name, rows: seen.append((name, rows.count())) or True)
    assert {tuple(r) for r in found.collect()} == {("sources", "raw", 1), ("concepts", "wiki", 2), ("indices", "index", 2)}
    assert dict(seen) == {"sources": 1, "concepts": 2, "indices": 2}
    with pytest.raises(RuntimeError, match="sources"):
        vault.register_collections(docs, lambda name, rows: False)


def test_stems_anywhere_in_a_text(spark):
    stems = spark.createDataFrame([("doc-1",), ("doc-10",), ("a b",), ("missing",), ("x",)], "stem string")
    text = spark.createDataFrame([("see doc-10.\nand a b\ndoc\n-1",)], "text string")
    assert {r["stem"] for r in lint.named_in(stems, text).collect()} == {"doc-1", "doc-10", "a b"}


def test_search_and_get(spark):
    docs = spark.createDataFrame([(1, "alpha beta", [1.0, 0.0]), (2, "beta", [0.0, 1.0]), (3, "gamma", [1.0, 1.0])], "k int, text string, v array<double>")
    assert [r["k"] for r in retrieval.search(docs, "k", "text", ["beta"], 5).collect()] == [2, 1]
    assert {r["k"] for r in retrieval.search(docs, "k", "text", ["beta"], 5, "v", lambda q: [1.0, 0.0]).collect()} == {1, 2, 3}

    def broken(q):
        raise ConnectionError("no model")

    with pytest.raises(ConnectionError):
        retrieval.search(docs, "k", "text", ["beta"], 5, "v", broken)
    assert retrieval.get(docs, "k", 2).first()["text"] == "beta"
    for frame, value in ((docs, 9), (docs.union(docs), 1)):
        with pytest.raises(KeyError):
            retrieval.get(frame, "k", value)


def test_registries_and_modes(spark):
    assert filters.thresholds({"thin_body": 10})["thin_body"] == 10
    with pytest.raises(KeyError):
        filters.thresholds({"none": 1})
    with pytest.raises(ValueError, match="twice"):
        filters.register("empty_shell", "gate")
    with pytest.raises(ValueError, match="lane"):
        filters.register("other", "elsewhere")
    with pytest.raises(ValueError, match="mode"):
        chunking.chunk(F.lit("x"), "half", 400)
    with pytest.raises(ValueError, match="window"):
        chunking.chunk(F.lit("x"), "full", 100)


def test_no_silent_ends(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "src int, dst int")
    assert {r["component"] for r in graph.components(path).collect()} == {0}
    with pytest.raises(RuntimeError, match="settle"):
        graph.components(path, max_rounds=1)
    deep = spark.createDataFrame([(0, None, 0)] + [(i, i - 1, 0) for i in range(1, 12)], "id int, parent int, ord int")
    assert graph.flatten_tree(deep).count() == 12
    with pytest.raises(RuntimeError, match="levels"):
        graph.flatten_tree(deep, max_depth=3)


def test_span_coverage_by_intervals(spark):
    g = "123e4567-e89b-12d3-a456-426614174000"
    texts = [f"{g}.pdf", f"a.txt-{g}", f"x {g} y", f"{g}{g}", f"report.v2.docx, {g}.zip.", "", "plain words", f"é {g}é.png"]
    for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", filters.span_coverage(F.col("t")).alias("c")).collect():
        covered = set()
        for pattern in (filters.GUID, filters.FILENAME):
            for m in re.finditer(pattern, r["t"], re.ASCII):
                covered |= {i for i in range(*m.span()) if not r["t"][i].isspace()}
        dense = sum(not c.isspace() for c in r["t"])
        assert r["c"] == (round(len(covered) / dense, 4) if dense else 0.0), r["t"]
