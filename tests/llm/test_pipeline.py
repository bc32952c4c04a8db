"""The pipeline's stages, each on its own input and against plain versions."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline as C


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in C.STAGES:
        docs = C.stored(stage(spark, docs, sf_dir), name)
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0
    per_doc = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t"))
    assert per_doc.count() == sizes[3] and per_doc.where("n <> t").isEmpty()


def test_stages_keep_clean_rows(spark, sf_dir):
    rows = [
        (1, "A clean text of some ten words or so, kept.", "en", "s", 10),
        (1, "A clean text of some ten words or so, kept.", "en", "s", 10),
        (None, "No id, yet a text that is kept as it stands.", "en", None, None),
        (3, None, None, None, None),
        (4, "12 34", "de", "s", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    told = C.language(spark, docs, sf_dir)
    assert sorted(str(r["doc_id"]) for r in told.collect()) == ["1", "1", "None"]
    kept = C.near_duplicates(spark, C.stored(told, "told"), sf_dir)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "None"]
    cut = C.repeated_passages(spark, kept, sf_dir)
    assert {r["text"] for r in cut.collect()} == {rows[0][1], rows[2][1]} and cut.columns == docs.columns
    assert C.benchmark_leaks(spark, cut, sf_dir).count() == 2
    assert C.packing(spark, cut, sf_dir).count() >= 2
    for _, stage in C.STAGES:
        assert stage(spark, docs.where("false"), sf_dir).count() == 0


def test_columns_named_like_outputs(spark, sf_dir):
    """Further columns with the names of everything that the operators add or use inside stay as they are, and change nothing."""
    clashing = "lang_pred score bits_per_byte kept n_bytes span_starts span_ends contaminated n_words n_hit item_ids component_id __key __first __text __keep0 __col1 id crc Kept_".split()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    more = docs.select(*docs.columns, *[F.lit(f"own {c}").alias(c) for c in clashing])
    for name, stage in C.STAGES[:-1]:
        plain, out = stage(spark, docs, sf_dir), stage(spark, more, sf_dir)
        assert out.columns == more.columns, name
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, out.select(*docs.columns).collect())), name
        assert {tuple(r) for r in out.select(*clashing).distinct().collect()} == {tuple(f"own {c}" for c in clashing)}, name
    assert C.packing(spark, more, sf_dir).count() == C.packing(spark, docs, sf_dir).count()


def test_cut_characters_are_whole(spark, sf_dir):
    passage = "é" * 120
    rows = [(1, "x" + passage, "fr", "s", 1), (2, "yy" + passage + " la fin", "fr", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in C.repeated_passages(spark, docs, sf_dir).collect()}
    assert got[1].startswith("x") and got[2].startswith("yy") and got[2].endswith(" la fin") and "�" not in "".join(got.values())


def _near(a, b):
    return len(a & b) * 5 >= len(a | b) * 4


def _kept_by_brute_force(rows):
    """Ids that the near-duplicate stage keeps: the least of each component of pairs with a Jaccard coefficient of 0.8 or more."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (not sets[i] and not sets[j]) or (sets[i] and sets[j] and _near(sets[i], sets[j])):
                root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return sorted(min(g) for g in groups.values())


def test_near_duplicates_against_brute_force(spark, sf_dir):
    words = [f"w{i * i % 1009}x{i}" for i in range(120)]
    edits = [(k, " ".join("other" if i in range(5, 5 + k * 2) else x for i, x in enumerate(words))) for k in range(12)]
    rows = [(10_000_000 + k, t) for k, t in edits] + [(20_000_000 + k, "a b c d") for k in range(3)] + [(30_000_000, " "), (30_000_001, None)]
    table = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += table + [(d + 50_000_000, (t or "") + " and some words") for d, t in table[:60]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["doc_id"] for r in C.near_duplicates(spark, docs, sf_dir).collect())
    assert got == _kept_by_brute_force(rows)


def test_near_copies_split_groups(spark):
    from quillspark.llm.near_copies import near_copies

    words = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join([*words, f"end{k}"])) for k in range(40)] + [(100 + k, f"quite another text number {k} of its own words {k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, near_copies(docs).collect()))
    assert whole == sorted(map(tuple, near_copies(docs, key_rows=7).collect()))
    assert {c for d, c in whole if d < 100} == {0}


def test_fingerprints_find_copies_and_the_check_decides(spark, monkeypatch):
    """The stage goes through SimHash; what it finds is checked, what its bits lose is found all the same, whatever the budget."""
    from quillspark.llm import near_copies

    words = [f"w{i * i % 1009}x{i}" for i in range(400)]
    rows = [(k, " ".join([*words[:k], "other", *words[k + 1 :]])) for k in range(0, 30, 6)] + [(100 + k, f"other words stand in text number {k} of this table {k}") for k in range(20)]
    rows += [(200 + k, " ".join("other" if i in range(5, 5 + k * 16) else x for i, x in enumerate(words))) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, plain = [], near_copies.by_fingerprints
    monkeypatch.setattr(near_copies, "by_fingerprints", lambda *a: seen.append(plain(*a)) or seen[-1])
    for budget, blocks in ((6, 8), (0, 4)):
        got = {r["component_id"] for r in near_copies.near_copies(docs, budget=budget, blocks=blocks).collect()}
        assert got == set(_kept_by_brute_force(rows))
    assert seen[0].count() >= 5 > seen[1].count()
    # Whatever the bits say: with all sets in one group, only those that have the coefficient are a class.
    monkeypatch.setattr(near_copies, "by_fingerprints", lambda distinct, *_: distinct.select("sig", "one", F.col("sig").alias("cls"), F.lit(0).cast("long").alias("root")))
    got = {r["component_id"] for r in near_copies.near_copies(docs).collect()}
    assert got == set(_kept_by_brute_force(rows))
    assert C.near_duplicates(spark, docs, "").count() == len(got)


def test_workers_drop_tables_of_other_stages(spark, sf_dir):
    """The tokenizer's table stays for further packing only; tasks of other stages give its memory back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert C.packing(spark, docs.repartition(8), sf_dir).count() > 0

    def held(batches):
        import pyarrow as pa

        from quillspark.llm import tokens

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(tokens._WORKER_TABLES)] * batch.num_rows)], names=["n"])

    from quillspark.llm.common import map_batches

    assert map_batches(spark.range(64, numPartitions=8), held, "n long").where("n > 0").isEmpty()


def test_a_block_is_encoded_in_parts():
    """The arrays of a block's pieces are held for a part of it only, and the ids are those of the library."""
    import tracemalloc

    import pyarrow as pa

    from quillspark.llm.tokens import BatchTokenizer, tokenizer_path

    texts = [" ".join(f"{w} w{(i * 31 + k) % 977}," for k, w in enumerate(("some", "words", "of", "a", "text") * 40)) for i in range(2000)] + ["", None]
    t, block = BatchTokenizer(tokenizer_path(), 1), pa.array(texts)
    tracemalloc.start()
    ids, n = t.encode(block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(n) == len(texts) and n.sum() == len(ids) and peak < 150 << 20, peak
    ends = n.cumsum()
    for i in (0, 700, 1999, 2000, 2001):
        assert ids[ends[i] - n[i] : ends[i]].tolist() == [*t.tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 1]


def test_near_copies_leave_no_sketches_behind(spark, tmp_path, monkeypatch):
    """What is stored on the way goes when nothing reads it any more: the stages after this one have the disk."""
    from quillspark.llm import common, near_copies

    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    docs = spark.createDataFrame([(i, " ".join(f"w{i // 2 * 3 + k}" for k in range(40))) for i in range(12)], "doc_id long, text string")
    out = near_copies.near_copies(docs)
    left = {p.name for p in tmp_path.glob("quillspark-*/*")}
    assert "rooted" in left and not left & {"sketches", "distinct", "classes"}
    assert {r["component_id"] for r in out.collect()} <= set(range(0, 12, 2))


def test_few_edges_have_the_components_of_many(spark):
    from quillspark.llm.near_copies import connected

    rows = [(i, i + 1) for i in range(-20, 20) if i % 7] + [(-(1 << 62), 5), (5, 5), (100, 50), (100, 99), (1 << 62, 99)]
    edges = spark.createDataFrame(rows, "a long, b long").repartition(3)
    own = sorted(map(tuple, connected(edges).collect()))
    assert own == sorted(map(tuple, connected(edges, few=0).collect())) and (1 << 62, 50) in own and (6, -(1 << 62)) in own
    assert connected(edges.where("false")).isEmpty()
