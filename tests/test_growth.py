"""What keeps queries within their limits on larger tables: plans and results of the steps that grew."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.operators import dedup, filters, repair, retrieval, translation


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_glossary_meets_sources(spark, monkeypatch):
    """The side that is sent around is the glossary; one that is too large for that gives the same rows."""
    p = spark.createDataFrame([(1, "part a part b", "AB"), (2, "pa", "B"), (3, "", ""), (4, "part b", "BB")], "doc_id int, source string, target string")
    g = spark.createDataFrame([("part a", "A"), ("part b", "B"), ("pa", "B"), ("none", None)], "term string, english string")
    small = translation.retention(p, g)
    assert "Inner, BuildRight" in plan(small) and "BuildLeft" not in plan(small)
    want = {(1, "part a", 1, 1), (1, "part b", 1, 1), (1, "pa", 2, 1), (2, "pa", 1, 1), (4, "part b", 1, 2), (4, "pa", 1, 2)}
    assert {tuple(r) for r in small.collect()} == want
    monkeypatch.setattr(translation, "SMALL", 0)
    large = translation.retention(p, g)
    assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
    assert {tuple(r) for r in large.collect()} == want and large.count() == len(want)


def test_near_pairs_store_no_sets(spark, monkeypatch):
    """What is stored of a document is a tenth of its shingles, and pairs that share too few of those go no further."""
    stored, cut = [], dedup.cut_lineage
    monkeypatch.setattr(dedup, "cut_lineage", lambda d: stored.append(cut(d)) or stored[-1])
    own = [(i, [f"w{i}_{j}" for j in range(40)] + "a b c d e".split() + [f"v{i}_{j}" for j in range(15)]) for i in range(8)]
    text = [f"t{j}" for j in range(100)]
    rows = [*own, (20, text), (21, [*text[:-1], "x"]), (22, text), (23, text[:-8]), (24, [])]
    d = spark.createDataFrame([(k, w, 1, len(w)) for k, w in rows], "k int, w array<string>, v int, z int")
    found = {(r["loser"], r["winner"], round(r["similarity"], 4)) for r in dedup.near_pairs(d, "k", "w", "v", "z").collect()}
    assert found == {(22, 20, 1.0), (21, 20, round(95 / 97, 4)), (23, 20, round(88 / 96, 4))} | ({(23, 21, round(88 / 96, 4))})
    widest = max(len(v) for f in stored for r in f.collect() for x in r.asDict(recursive=True).values() for v in (x.values() if isinstance(x, dict) else [x]) if isinstance(v, list))
    assert widest <= 11
    assert {frozenset(r) for r in stored[-1].collect()} == {frozenset(p) for p in ((20, 21), (20, 23), (21, 23))}


def test_shares_count_and_copy_nothing(spark):
    d = spark.createDataFrame([("aG1é\n",), ("",), ("\u200ffF9",)], "t string").select(filters.char_share(F.col("t"), "0-9A-Fa-f").alias("x"))
    assert "regexp_replace" not in plan(d)
    assert [r["x"] for r in d.collect()] == [0.4, 0.0, 0.75]


def test_line_shares_split_once(spark):
    d = spark.createDataFrame([("# a\n\u2003\n|b|c|\n\nd",), ("\n \n",), ("",)], "t string").select(filters.line_share(F.col("t"), lambda x: F.ltrim(x).startswith("#")).alias("x"))
    assert plan(d).count("split(") == 1
    assert [r["x"] for r in d.collect()] == [0.3333, 0.0, 0.0]


def test_neighbours_in_parts(spark, monkeypatch):
    """The same neighbours, ties by key, however many groups, blocks and parts meet."""
    v = [(i, [float(i % 7), float(i * i % 5) + 0.5, 1.0]) for i in range(60)]
    d = spark.createDataFrame(v, "id long, v array<float>")
    unit = {i: [x / sum(y * y for y in r) ** 0.5 for x in r] for i, r in v}
    want = {(q, j + 1, n) for q in range(0, 60, 5) for j, (_, n) in enumerate(sorted((-round(sum(a * b for a, b in zip(unit[q], unit[i], strict=True)), 6), i) for i in unit if i != q)[:4])}
    for limit in (10_000, 5):
        for name in ("QUERIES", "ROWS", "SCORES"):
            monkeypatch.setattr(retrieval, name, limit)
        assert {(r["query"], r["rank"], r["neighbour"]) for r in retrieval.knn_self(d, "id", "v", F.col("k") % 5 == 0, 4).collect()} == want


def test_repair_reads_its_row_alone(spark):
    """A text isn't shuffled to meet its own verdict, and plain stretches, links and fences stay as they are."""
    rows = [(1, "a! ךלמ [x ךלמ](ךלמ) ![ךלמ b\n```\nךלמ\n```\nךלמ"), (2, "plain [x] text!\nb"), (3, "")]
    d = repair.reverse_runs(spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "CAST(text AS BINARY) AS raw", "'a.md' AS path"))
    assert "Join" not in plan(d) and "Exchange" not in plan(d)
    assert {r["doc_id"]: (r["repaired"], r["healed"]) for r in d.collect()} == {1: ("a! מלך [x ךלמ](ךלמ) ![מלך b\n```\nךלמ\n```\nמלך", False), 2: (rows[1][1], True), 3: ("", True)}


def test_reconversion_reads_texts_once(spark, sf_dir):
    from quillspark.plans import registry

    p = plan(registry.queries()["recon_accept"](spark, sf_dir))
    assert "documents.parquet" not in p and "__cl" not in p
