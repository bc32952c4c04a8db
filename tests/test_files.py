"""Files, sinks and streams in a temporary folder."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillspark.operators.ledger import project
from quillspark.sources import vault_files as V
from quillspark.streaming import ledger as S


def test_notes(spark, tmp_path):
    for name in ("raw/a.md", "wiki/x/b.md", "index/log.md", "tests/secret.md"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f"text of {name}")
    got = {(r["folder"], r["stem"], r["text"]) for r in V.read_notes(spark, str(tmp_path)).collect()}
    assert got == {("raw", "a", "text of raw/a.md"), ("wiki/x", "b", "text of wiki/x/b.md"), ("index", "log", "text of index/log.md")}


def test_ledger_file(spark, tmp_path):
    p = str(tmp_path / "ledger")
    for status in ("new", "done"):
        V.append_ledger(spark.createDataFrame([("a", status)], "doc_id string, status string"), p)
    assert V.read_ledger(spark, p).count() == 2


def test_ledger_order_is_the_order_of_appends(spark, tmp_path):
    """Later events in larger files, several files per append, blank lines, and a file that someone else wrote before."""
    p = tmp_path / "ledger"
    p.mkdir()
    (p / "old.jsonl").write_text('{"doc_id": "a", "status": "zeroth"}\n\n{"doc_id": "b", "status": "first"}\n{"doc_id": "b", "status": "second"}\n')
    V.append_ledger(spark.createDataFrame([("a", "first", "x")], "doc_id string, status string, stage string"), str(p))
    many = spark.createDataFrame([("a", f"s{k:04}", "x" * 500) for k in range(400)] + [("a", "last", "x")], "doc_id string, status string, stage string")
    V.append_ledger(many.repartitionByRange(3, "status").sortWithinPartitions("status"), str(p))
    V.append_ledger(spark.createDataFrame([("c", "only", "x")], "doc_id string, status string, stage string"), str(p))
    got = {r["key"]: r["status"] for r in project(V.read_ledger(spark, str(p)).select("doc_id", "seq", "status"), "doc_id", "seq").collect()}
    assert got == {"a": "s0399", "b": "second", "c": "only"}


def test_chunks_are_written_once(spark, tmp_path):
    p = str(tmp_path / "store")
    c = spark.createDataFrame([("x",), ("y",), ("x",)], "chunk string")
    V.write_chunks(c, p)
    V.write_chunks(c.union(spark.createDataFrame([("z",)], "chunk string")), p)
    assert spark.read.parquet(p).count() == 3
    with pytest.raises(ValueError):
        V.refuse_inside("/a/b/out", "/a/b")


def test_stream_projection_and_ingest(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "state")
    for k in range(3):
        spark.range(4).select((F.col("id") % 2).cast("string").alias("doc"), (F.col("id") + 10 * k).alias("seq"), F.lit(f"s{k}").alias("status")).coalesce(1).write.mode("append").parquet(source)
    stream = S.read_events(spark, source, "doc string, seq long, status string", 1)
    S.project_stream(stream, "doc", "seq", target, str(tmp_path / "c1")).awaitTermination()
    state = spark.read.parquet(S.state_path(spark, target))
    assert {(r["key"], r["seq"], r["status"]) for r in state.collect()} == {("0", 22, "s2"), ("1", 23, "s2")}
    docs, out = str(tmp_path / "docs"), str(tmp_path / "out")
    for texts in (["a", "b"], ["b", "c", "c"]):
        spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.mode("append").parquet(docs)
    for _ in range(2):
        S.ingest_stream(S.read_events(spark, docs, "text string", 1), out, str(tmp_path / "c2")).awaitTermination()
    assert sorted(r["text"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_idempotent_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "doc string, n int").write.parquet(source)
    q = S.idempotent(S.read_events(spark, source, "doc string, n int"), ["doc", "n"]).writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == 2
