"""The training-data operators: brute force, round trips, held-out accuracy, and rows of every awkward kind."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillspark.llm import bfd_pack, decontaminate, html_text, ppm_language, simhash, suffix_dedup, syncmers, toxicity, url_filter, vector_pack
from quillspark.llm.tokens import BatchTokenizer, tokenizer_path

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
#: Nulls in any column, empty and blank texts, a very long one, repeated rows, one id with two texts, a clashing extra column.
AWKWARD = [
    (1, "Plain text, with words and more words.", "en", "x"),
    (1, "Plain text, with words and more words.", "en", "x"),
    (2, None, "en", None),
    (3, "", None, "y"),
    (4, " \t\n ", "de", "z"),
    (None, "A text without an id but with words.", None, "z"),
    (5, "é😀 ÄÖÜ straße İ ſ \x00 end", "de", "é"),
    (6, LONG, "en", "long"),
    (7, "first of two texts", "en", "a"),
    (7, "second of two texts", "fr", "b"),
    (8, "12345 67 !!! ---", "es", "n"),
]
SCHEMA = "doc_id long, text string, lang string, seq string"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).withColumn("n", F.lit(1)).withColumn("id", F.lit("clash")).withColumn("ids", F.lit("clash")).withColumn("crc", F.lit(2)).withColumn("host", F.lit("h"))


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- tokens and packing ---------------------------------------------------------------------------------------------------


def test_batch_tokens_equal_the_library(spark, sf_dir):
    import pyarrow as pa

    texts = [r["text"] for r in documents(spark, sf_dir).limit(60).collect()] + [a[1] for a in AWKWARD] + ["don't we'll I'M o'clock 3.14 a.b,c!!x <|endoftext|> x", "Ångström ﬁn é ​x y", "İSTANBUL ΣΑΣ ς"]
    t = BatchTokenizer(tokenizer_path(), 1)
    ids, n = t.encode(pa.array(texts))
    want = [t.tokenizer.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_batch_tokens_on_odd_texts_and_with_a_small_table():
    import pyarrow as pa

    rnd = random.Random(5)
    alphabet = "aAbBsStTreveEmMlLdD..,,!?--  \t\n \u0085\x1c019\u0663éÉßçÇñÑ×÷ªµİıſẞΣσςΑάK\u037e` “”…—漢字の\u30abか\u3099\u0301\u0308\u030aWwHjJʼ<|>≯=≠🙂\x00\x7f\u212bﬁǅ"
    texts = ["<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>", "x" * 5000, "é" * 400, "'" * 50]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(6000)]
    t = BatchTokenizer(tokenizer_path(), 1, table_bytes=300_000)
    want = _encoded(texts)
    for at in range(0, len(texts), 500):
        ids, n = t.encode(pa.array(texts[at : at + 500]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want[at : at + 500]
    assert t.piecewise and t.table.n_bytes < 1_000_000


def test_other_tokenizer_files_are_encoded_text_by_text():
    import pyarrow as pa

    t = BatchTokenizer(tokenizer_path("byte_bpe_50k.json"), 1)
    texts = ["Upper  and lower, it's 3.14", None, "  é \n\n x"]
    ids, n = t.encode(pa.array(texts))
    assert not t.piecewise
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [t.tokenizer.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def test_ids_that_a_width_cannot_hold_are_errors(spark):
    df = spark.createDataFrame([("a", "x y z")], "doc_id string, text string")
    with pytest.raises(ValueError, match="2 bytes"):
        bfd_pack.pack_tokens(df, end_id=65536)
    with pytest.raises(ValueError, match="2 bytes"):
        bfd_pack.pack_tokens(df, capacity=70_000)
    (row,) = bfd_pack.pack_tokens(df, end_id=70_000, id_bytes=4, capacity=70_000).collect()
    assert row["doc_ids"] == ["a"] and np.frombuffer(row["input_ids"], "<u4")[row["n_tokens"] - 1] == 70_000
    assert {r["doc_id"] for r in vector_pack.pack_examples(df).collect()} == {"a"}


def _plain_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if sum(b) + n <= capacity]
        if fits:
            max(fits, key=sum).append(n)
        else:
            bins.append([n])
    return bins


def test_packing_equals_a_plain_version(spark, sf_dir):
    """op1's rows against best-fit-decreasing written out plainly, with the sequences that are opened again."""
    docs = documents(spark, sf_dir).coalesce(1)
    lengths = [len(x) for x in _encoded([r["text"] for r in docs.collect()])]
    rows = bfd_pack.pack_tokens(docs, capacity=512, block_bytes=1 << 30).collect()
    bins = _plain_best_fit([n % 512 for n in lengths if n % 512], 512)
    loose = sorted((b for b in bins if sum(b) < 0.95 * 512), key=sum)[: bfd_pack.REOPEN]
    want = [512] * sum(n // 512 for n in lengths) + [sum(b) for b in bins]
    for b in loose:
        want.remove(sum(b))
    want += [sum(b) for b in _plain_best_fit([n for b in loose for n in b], 512)]
    assert sorted(r["n_tokens"] for r in rows) == sorted(want)


def _encoded(texts):
    t = BatchTokenizer(tokenizer_path(), 1).tokenizer
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def _check_pieces(rows):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048 and pieces[0]["sequence_tokens"] == at
        assert pieces[0]["padded_to"] == (at if at & (at - 1) == 0 else 2048)


def test_vector_packing_is_lossless(spark, awkward, nothing):
    rows = vector_pack.pack_examples(awkward.repartition(2)).collect()
    _check_pieces(rows)
    want = sorted((a[0] or -1, w) for a, w in zip(AWKWARD, _encoded([a[1] for a in AWKWARD]), strict=True))
    total = sum(len(w) for _, w in want)
    assert sum(r["length"] for r in rows) == total
    for doc in {a[0] for a in AWKWARD} - {1, 7}:
        own = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"])
        ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in own), "<u4").tolist()
        assert ids == next(w for d, w in want if d == (doc or -1))
        assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and r["doc_tokens"] == len(ids) for r in own)
    assert vector_pack.pack_examples(nothing).count() == 0


def test_vector_packing_limits(spark):
    rows = [(i, "say " * (i % 40), "answer " * (1 + i % 300)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, prompt string, text string").coalesce(1)
    limits = vector_pack.Limits(tokens=512, segments=4, loss_tokens=300)
    out = vector_pack.pack_examples(df, prompt_col="prompt", limits=limits, block_bytes=20_000).toPandas()
    g = out.groupby("sequence_id").agg(n=("length", "sum"), k=("length", "size"), loss=("loss_tokens", "sum"), to=("padded_to", "first"))
    assert (g.n <= 512).all() and (g.k <= 4).all() and (g.loss <= 300).all()
    assert ((g.to == g.n) | (g.to == 512)).all()
    d = out.groupby("doc_id").agg(n=("length", "sum"), t=("doc_tokens", "first"), loss=("loss_tokens", "sum"))
    assert (d.n == d.t).all() and len(d) == 600
    assert all(d.loss[i] == 1 + i % 300 + 1 for i in range(600))


def test_best_fit_decreasing_and_matrices(spark, awkward, nothing):
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 2049, 3000)
    bins = bfd_pack.best_fit_decreasing(lengths, 2048)
    assert sorted(i for b in bins for i in b) == list(range(3000))
    assert all(lengths[b].sum() <= 2048 for b in bins) and len(bins) <= 1.05 * lengths.sum() / 2048 + 1
    free, count = [], 0  # brute force: the open bin with the least room that holds the item
    for n in sorted(lengths.tolist(), reverse=True):
        room = min((r for r in free if r >= n), default=None)
        if room is None:
            count += 1
            room = 2048
        else:
            free.remove(room)
        free.append(room - n)
    assert count == len(bins)
    rows = bfd_pack.pack_tokens(awkward, capacity=256).collect()
    back = {}
    for r in rows:
        ids = np.frombuffer(bytes(r["input_ids"]), "<u2")
        pos = np.frombuffer(bytes(r["position_ids"]), "<u2")
        assert len(ids) == 256 and r["cu_seqlens"][-1] == r["n_tokens"] == sum(r["lengths"])
        for k, (d, s, n) in enumerate(zip(r["doc_ids"], r["starts"], r["lengths"], strict=True)):
            a = r["cu_seqlens"][k]
            assert pos[a : a + n].tolist() == list(range(n))
            back.setdefault(d, []).append((s, ids[a : a + n].tolist()))
        assert (ids[r["n_tokens"] :] == 49407).all()
    want = {a[0]: w[:-1] + [49407] for a, w in zip(AWKWARD, _encoded([a[1] for a in AWKWARD]), strict=True)}
    for d in set(want) - {1, 7}:
        assert [i for _, part in sorted(back[d]) for i in part] == want[d]
    assert bfd_pack.pack_tokens(nothing).count() == 0


# --- URLs -----------------------------------------------------------------------------------------------------------------


def test_url_rules(spark):
    urls = {
        "http://www.Example.COM/en/7x?q": ("www.example.com", "/en/7x", "example.com/en/7", "allow"),
        "https://a.com/en/": ("a.com", "/en/", "com/en/", "block"),
        "https://acom/en/": ("acom", "/en/", None, "allow"),
        "https://example.net/de/8": ("example.net", "/de/8", "example.net/de/8", "block"),
        "https://x.example.net/de/9#f": ("x.example.net", "/de/9", "net/de/", "allow"),
        "ftp://b.org/es/y": ("b.org", "/es/y", "org/es/", "block"),
        "http://ads.com/en/1": ("ads.com", "/en/1", "com/en/", "block"),
        "http://ads.shop/x": ("ads.shop", "/x", None, "block"),
        "http://a.fr/LOGIN": ("a.fr", "/LOGIN", None, "block"),
        "http://a.com/x/ADS/Banner/y": ("a.com", "/x/ADS/Banner/y", None, "block"),
        "http://blog.adult-x.example.fr/q": ("blog.adult-x.example.fr", "/q", None, "block"),
        "http://adultx.example.fr/logins": ("adultx.example.fr", "/logins", None, "allow"),
        "http://a.fr/EN/": ("a.fr", "/EN/", None, "allow"),
        "http://a.com/EN/": ("a.com", "/EN/", None, "allow"),
        "http://host?a=/en/": ("host", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "http://": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u) for i, u in enumerate(urls)] + [(99, "https://a.com/en/"), (None, "https://a.com/en/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit("clash")).withColumn("token", F.lit("clash")).withColumn("h", F.lit(1))
    rules = url_filter.rule_table(spark, [url_filter.prefix_rule(*r) for r in url_filter.PREFIX_RULES] + list(url_filter.PATTERN_RULES))
    for bound in (10**6, 0):
        out = url_filter.judge_urls(df, rules, keep=["page_id", "url"], broadcast_bytes=bound).collect()
        assert len(out) == len(rows)
        for r in out:
            name = None if r["rule"] and r["rule"].startswith("pattern:") else r["rule"]
            assert (r["host"], r["path"], name, r["verdict"]) == urls[r["url"]], r
        assert url_filter.judge_urls(df, rules, keep=["page_id", "token", "h"], broadcast_bytes=bound).count() == len(rows)
    assert url_filter.judge_urls(df.where("false"), rules, keep=["page_id"]).count() == 0
    with pytest.raises(ValueError, match="Host"):
        url_filter.judge_urls(df.withColumnRenamed("host", "Host"), rules, keep=["page_id", "Host"])


def test_patterns_need_their_tokens_and_the_index_misses_nothing(spark):
    """Random URLs made of the rules' own parts: whoever matches holds all tokens, and the result is that of trying every rule."""
    import re

    written = ["||ads.", "|ads.x^", "^login|", "*ads^x*", "ads", "^a^*b^", "/x/ads*", "||shop.fr/ads^x|", "-x-"]
    rules = [*url_filter.PATTERN_RULES, *(url_filter.pattern_rule(w, "allow" if i % 2 else "block") for i, w in enumerate(written))]
    assert [url_filter.pattern_rule(w).tokens for w in written] == [("ads",), ("ads", "x"), ("login",), (), (), ("a",), ("x",), ("shop", "fr", "ads", "x"), ("x",)]
    rnd = random.Random(3)
    parts = ["ads", "x", "a", "b", "login", "shop", "fr", "adult", "banner", ".", "/", "-", "_", "ADS", "é", "1", "spam", "farm"]
    urls = ["http://" + "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(800)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = url_filter.rule_table(spark, rules)
    for bound in (10**6, 0):
        out = url_filter.judge_urls(df, table, keep=["page_id"], broadcast_bytes=bound).collect()
        seen = set()
        for r in out:
            place = "".join(c.lower() if c.isascii() else c for c in r["host"] + r["path"])
            match = [x for x in rules if re.search(x.pattern.replace("\\z", "\\Z"), place)]
            assert all(set(x.tokens) <= set(re.findall(url_filter.TOKEN, place)) for x in match)
            want = max(match, key=lambda x: (x.rank, x.name), default=None)
            assert (r["rule"], r["verdict"]) == ((want.name, want.action) if want else (None, "allow"))
            seen.add(r["rule"])
        assert len(seen) >= 5


# --- suffix dedup -----------------------------------------------------------------------------------------------------------


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def _digest(rows):
    return {r["doc_id"]: (r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["span_starts"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows}


def test_repeats_equal_brute_force(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    base = " ".join(rnd.choice(words) for _ in range(300))
    rows = []
    for i in range(240):
        edited = base.split(" ")
        edited[rnd.randrange(len(edited))] = rnd.choice(words)
        kinds = [base, base[rnd.randint(0, 300) :][: rnd.randint(0, 900)], " ".join(edited), "a" * rnd.randint(90, 400), " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 200))) + base[100:260], None if rnd.random() < 0.3 else "ab" * rnd.randint(0, 120)]
        rows.append((i, kinds[i % 6]))
    want = brute_repeats(rows)
    df = spark.createDataFrame(rnd.sample(rows, len(rows)), "doc_id long, text string").repartition(5)
    for hot in (20_000, 30, 3):  # no frequent anchors; such as shrink when their parts meet again; and such as don't
        assert _digest(suffix_dedup.remove_repeats(df, hot=hot, collection_bytes=20_000).collect()) == want


def test_repeats_on_real_rows(spark, sf_dir):
    docs = documents(spark, sf_dir)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.op3_suffix_dedup(spark, sf_dir).collect()}
    assert got == brute_repeats([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_repeats_awkward(spark, awkward, nothing, monkeypatch):
    rows = suffix_dedup.remove_repeats(awkward, keep=["doc_id", "seq"]).collect()
    assert len(rows) == len(AWKWARD)
    long = next(r for r in rows if r["doc_id"] == 6)
    assert (len(long["kept"]), len(long["span_starts"])) == (brute_repeats([(6, LONG)])[6][0] - brute_repeats([(6, LONG)])[6][1], brute_repeats([(6, LONG)])[6][2])
    assert [len(r["kept"]) for r in rows if r["doc_id"] == 1] == [38, 38]
    assert suffix_dedup.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize(("block", "file_bytes"), [(1 << 18, 1 << 25), (7, 0), (64, 100)])
def test_column_wise_sorts_suffixes(block, file_bytes):
    """Any block size, and files on disk from the first byte on."""
    rnd = random.Random(1)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 30))) for _ in range(40)] + [b"", b"abab"]
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    rows = np.concatenate(list(suffix_dedup.column_wise(data, offsets, block, file_bytes)))
    _, lcp, size, seg = suffix_dedup._fields(rows)
    keys = [(texts[s][len(texts[s]) - n :], s) for s, n in zip(seg.tolist(), size.tolist(), strict=True)]
    assert keys == sorted(keys) and len(keys) == len(data) + len(texts)
    for (a, _), (b, _), n in zip(keys, keys[1:], lcp[1:].tolist(), strict=False):
        common = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert n == common
    assert not list(suffix_dedup.column_wise(np.zeros(0, np.uint16), np.zeros(1, np.int64), block, file_bytes))


def test_least_between():
    rng = np.random.default_rng(3)
    for n in (1, 63, 64, 65, 1000, 20_000):
        values = rng.integers(0, 250, n).astype(np.uint8)
        a, b = rng.integers(0, n, 300), rng.integers(0, n, 300)
        a, b = np.minimum(a, b), np.maximum(a, b)
        assert suffix_dedup._least_between(values, a, b).tolist() == [values[x : y + 1].min() for x, y in zip(a, b, strict=True)]


@pytest.mark.parametrize("symbol", [4, 2, 1])
def test_symbols_of_several_bytes_find_the_same_windows(monkeypatch, symbol):
    rnd = random.Random(4)
    base = bytes(rnd.choice(b"abcd") for _ in range(400))
    texts = [base[p : p + rnd.randint(0, 150)] for p in (rnd.randint(0, 300) for _ in range(60))] + [b"x" + base[40:170], b"a" * 130]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    monkeypatch.setattr(suffix_dedup, "SYMBOL", symbol)
    doc, start, group = suffix_dedup.repeated_windows(data, offsets, 100)
    windows = {(d, p): texts[d][p : p + 100] for d in range(len(texts)) for p in range(len(texts[d]) - 99)}
    assert sorted(zip(doc.tolist(), start.tolist(), strict=True)) == sorted(windows)
    by_group = {}
    for d, p, g in zip(doc.tolist(), start.tolist(), group.tolist(), strict=True):
        by_group.setdefault(g, set()).add(windows[d, p])
    assert all(len(w) == 1 for w in by_group.values()) and len(by_group) == len(set(windows.values()))


def test_wide_symbols_take_few_rounds_whatever_their_kinds():
    """More kinds than 16 bits number: symbols stay wide, windows and groups are the same, in one block or in many."""
    rng = np.random.default_rng(9)
    unlike = [bytes(rng.integers(97, 123, 199).astype(np.uint8)) for _ in range(700)]
    texts = unlike + [b"ab" + unlike[5][20:150], unlike[5][25:180], unlike[6], b"short"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    symbols, ends, size = suffix_dedup._symbols(data, offsets, 100)
    assert len(np.unique(symbols)) > 65535 and np.diff(ends).max() * size <= 199 and np.diff(ends).max() < 10
    doc, start, group = suffix_dedup.repeated_windows(data, offsets, 100)
    windows = {(d, p): texts[d][p : p + 100] for d in range(len(texts)) for p in range(len(texts[d]) - 99)}
    found = {(d, p): g for d, p, g in zip(doc.tolist(), start.tolist(), group.tolist(), strict=True)}
    assert found.keys() == windows.keys()
    assert len(set(found.values())) == len(set(windows.values())) == len({(found[k], w) for k, w in windows.items()})
    whole = np.concatenate(list(suffix_dedup.column_wise(symbols, ends)))
    assert np.array_equal(whole, np.concatenate(list(suffix_dedup.column_wise(symbols, ends, 5000, 0))))


def test_hashes_alone_decide_nothing(spark, monkeypatch):
    """With hashes of no use, so that everything meets and looks equal, the result is the same."""
    rnd = random.Random(8)
    same = "".join(rnd.choice("abcdefgh ") for _ in range(160))
    rows = [(i, "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(100, 220)))) for i in range(40)] + [(50 + i, "x" * i + same) for i in range(4)]
    want = brute_repeats(rows)
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for _, t in rows])])
    doc, start, n, a, s = suffix_dedup.segments(data, offsets)
    # One hash for all: a chunk's segments are told apart by their bytes, a collection's windows by the transform.
    equal = np.zeros(len(doc), np.int64)
    import pyarrow as pa

    kept = suffix_dedup._settled(data, offsets[doc] + start, equal, equal, doc, equal, start, n, 100)
    lone = kept.filter(pa.compute.greater(kept.column("n"), 0)).to_pydict()
    cut = [bytes(data[offsets[d] + p : offsets[d] + p + (m & 255) + 99]) for d, p, m in zip(lone["id"], lone["start"], lone["n"], strict=True)]
    zero = [0] * len(cut)
    table = pa.table({"grp": zero, "anchor": zero, "hot": [False] * len(cut), "id": lone["id"], "crc": zero, "start": lone["start"], "at": [m >> 8 for m in lone["n"]], "data": cut}, schema=suffix_dedup._PIECE)
    spans = [(r["id"], r["s"], r["e"]) for r in suffix_dedup._decided(table, 100).to_pylist()] + [(i, p, p - m) for i, p, m in zip(*(kept.to_pydict()[k] for k in ("id", "start", "n")), strict=True) if m < 0]
    got = {k: set() for k in range(len(rows))}
    for d, b, e in spans:
        got[d] |= set(range(b, e))
    assert [len(g) for g in got.values()] == [w[1] for w in want.values()]


# --- language ---------------------------------------------------------------------------------------------------------------


def test_language_held_out(spark, sf_dir):
    out = ppm_language.op4_ppm_language(spark, sf_dir).join(documents(spark, sf_dir).select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out.held_out]
    assert len(held) > 20 and (held.lang == held.lang_pred).mean() >= 0.95
    assert out.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in zip(out.doc_id, out.held_out, strict=True))


def test_code_lengths_are_exact():
    import pyarrow as pa

    model = ppm_language.train({"a": [b"abracadabra " * 30, b"banana"], "b": [b"the cat sat on the mat " * 20]}, order=3)
    text = b"abracadabra the cat? banana zzz"
    want = np.zeros(2)
    for j, name in enumerate(model.languages):
        own = {"a": [b"abracadabra " * 30, b"banana"], "b": [b"the cat sat on the mat " * 20]}[name]
        for i in range(len(text)):
            bits, d = 0.0, min(i, 3)
            while d >= 0:
                context = text[i - d : i]
                follow = [t[k + d] for t in own for k in range(len(t) - d) if t[k : k + d] == context]
                kinds = len(set(follow))
                if text[i] in follow:
                    bits += np.log2((len(follow) + kinds) / follow.count(text[i]))
                    break
                bits += np.log2((len(follow) + kinds) / kinds) if follow else 0
                d -= 1
            else:
                bits += 8
            want[j] += bits
    got = ppm_language.code_lengths(model, pa.array(["", text.decode(), "x"]))
    assert np.allclose(got[1], want, rtol=1e-4) and got[0].tolist() == [0, 0]


def test_language_awkward(spark, awkward, nothing):
    out = ppm_language.identify(awkward, ppm_language.fit(awkward), keep=["seq", "n"]).collect()
    assert len(out) == len(AWKWARD)
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in out if r["doc_id"] in (2, 3, 4, 8))
    assert ppm_language.fit(nothing) is None
    assert ppm_language.identify(nothing, None).count() == 0
    assert {r["lang_pred"] for r in ppm_language.identify(awkward, None).collect()} == {"und"}


# --- near duplicates ----------------------------------------------------------------------------------------------------------


def brute_components(fps, budget=3):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= budget) + i + 1:
            x, y = root(i), root(int(j))
            parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(a))]


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    fps = {int(x) for x in rng.integers(0, 2**63, 200, dtype=np.uint64)}
    for b in rng.integers(0, 2**63, 25, dtype=np.uint64):
        for _ in range(25):
            x = int(b)
            for _ in range(rng.integers(0, 5)):
                x ^= 1 << int(rng.integers(0, 64))
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(x),) for x in np.array(fps, np.uint64).view(np.int64)], "fp long")
    want = {}
    for f, r in zip(fps, brute_components(fps), strict=True):
        want.setdefault(r, set()).add(f)
    for key_rows in (20_000, 5):
        comp = {r["node"]: r["root"] for r in simhash.components(simhash.fingerprint_links(df, key_rows=key_rows)).collect()}
        got = {}
        for f in fps:
            s = f - (1 << 64) if f >> 63 else f
            got.setdefault(comp.get(s, s), set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates(spark, sf_dir, awkward, nothing):
    docs = {r["doc_id"]: r["text"] for r in documents(spark, sf_dir).collect()}
    fps = {d: brute_fingerprint(t) for d, t in docs.items()}
    order = sorted(docs)
    roots = brute_components([fps[d] for d in order])
    least = {}
    for d, r in zip(order, roots, strict=True):
        least.setdefault(r, d)
    got = simhash.op6_simhash(spark, sf_dir).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {(d, f"{fps[d]:016x}", least[r]) for d, r in zip(order, roots, strict=True)}
    out = simhash.near_duplicates(awkward).collect()
    assert len(out) == len(AWKWARD)
    assert {r["component_id"] for r in out if r["doc_id"] in (2, 3, 4)} == {2}
    assert simhash.near_duplicates(nothing).count() == 0


# --- decontamination ------------------------------------------------------------------------------------------------------------


def brute_hits(docs, items, window=13):
    import regex

    pattern = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: pattern.findall((t or "").translate(low))
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    sizes = {len(w) for w in wins}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        out.append((d, len(w), len(hit), sorted(found - {"None"}), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("bound", [200_000, 0])
def test_decontamination(spark, awkward, bound, monkeypatch):
    rnd = random.Random(5)
    voc = ["Ab", "b", "c9", "été", "É", "İx", "x", "y", "zz"]
    text = lambda n: " ".join(rnd.choice(voc) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([30, 13, 12, 5, 4, 2, 14, 20])] + [(50, ""), (51, None), (None, "Plain text with"), (3, "two texts"), (0, "x")]
    docs = [(100 + i, f"{text(rnd.randint(0, 60))}, {items[i % 8][1]}! {text(9)}" if i % 3 == 0 else text(rnd.randint(0, 60))) for i in range(60)]
    docs += [(a[0], a[1]) for a in AWKWARD]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", F.lit("clash")).withColumn("n", F.lit(0)).withColumn("key", F.lit(0))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("size", F.lit(1))
    original = decontaminate.contained_windows
    monkeypatch.setattr(decontaminate, "contained_windows", lambda d, i, w: original(d, i, w, broadcast_bytes=bound))
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in decontaminate.decontaminate(df, bench).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(got, key=key) == sorted(brute_hits(docs, items), key=key)


def test_decontamination_empty(spark, awkward, nothing):
    bench = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.decontaminate(awkward, bench, keep=["doc_id", "seq"]).collect()
    assert len(out) == len(AWKWARD) and not any(r["n_hit"] or r["contaminated"] for r in out)
    assert decontaminate.decontaminate(nothing, bench).count() == 0
    assert decontaminate.decontaminate(nothing, awkward.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


def test_decontamination_oracle(spark, sf_dir):
    from oracle import same

    same(decontaminate.op7_decontamination(spark, sf_dir), decontaminate.OP7_SQL, sf_dir)


def test_url_oracle(spark, sf_dir):
    from oracle import same

    same(url_filter.op2_url_filter(spark, sf_dir), url_filter.OP2_SQL, sf_dir)


# --- fingerprints -----------------------------------------------------------------------------------------------------------------


def test_syncmers(spark, sf_dir):
    rows = syncmers.op8_syncmers(spark, sf_dir).toPandas().set_index("doc_id").sort_index()
    docs = sorted((r["doc_id"], r["text"] or "") for r in documents(spark, sf_dir).collect())
    for k, (d, t) in enumerate(docs):
        nxt, half = docs[(k + 1) % len(docs)][1], len(t) // 2
        assert rows.n_chars[d] == len(t)
        assert rows.edited_sha256[d] == hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()
    by_text = {}
    for d, t in docs:
        by_text.setdefault(t, set()).add(rows.fingerprint[d])
    assert all(len(v) == 1 for v in by_text.values())
    assert rows.near_edited.mean() > 0.2 and rows.near_next.median() < 0.05
    for k, (d, t) in enumerate(docs):
        nxt, half = docs[(k + 1) % len(docs)][1], len(t) // 2
        own = plain_anchors(t)
        assert rows.near_next[d] == plain_likeness(own, plain_anchors(nxt))
        assert rows.near_edited[d] == plain_likeness(own, plain_anchors(t[: len(t) - half] + nxt[:half]))
        assert rows.fingerprint[d] == "".join(f"{a:08x}" for a in sorted(own)[: syncmers.SKETCH])


def _hash(data):
    return xxhash.xxh64_intdigest(data, 42)


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_anchors(text):
    """First places of a text's closed syncmers, by the definition."""
    b, k, s = (text or "").encode(), syncmers.K, syncmers.S
    if len(b) < k:
        return {_hash(b) & 0x7FFFFFFF: 0} if b else {}
    h = [_signed(_hash(b[i : i + s])) for i in range(len(b) - s + 1)]
    out = {}
    for i in range(len(b) - k + 1):
        inside = h[i : i + k - s + 1]
        if min(inside) in (inside[0], inside[-1]):
            out.setdefault(_hash(b[i : i + k]) & 0x7FFFFFFF, i)
    return out


def plain_likeness(a, b):
    if not a and not b:
        return 1.0
    apart = [b[x] - a[x] for x in a.keys() & b.keys()]
    return sum(d == 0 or apart.count(d) > 1 for d in apart) / len(a.keys() | b.keys())


def test_anchors_are_context_free(spark):
    middle = "".join(f"tok{i * i % 97}漢é" for i in range(200))
    front = "other words in front, Straße "
    rows = [(1, middle), (2, front + middle + " and behind"), (3, "a b"), (4, ""), (5, None), (6, "a" * 100), (7, "x" * syncmers.K), (8, "ab" * 12)]
    got = {}
    for r in syncmers.anchors(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r["doc_id"], []).append((r["pos"], r["anchor"]))
    shift = len(front.encode())
    assert set(got[1]) <= {(p - shift, a) for p, a in got[2]}
    assert len(got[3]) == 1 and 4 not in got and 5 not in got and len(got[6]) == 100 - syncmers.K + 1 and len(got[7]) == len(got[8]) == 1
    for d, t in rows:
        assert {a: min(p for p, x in got[d] if x == a) for _, a in got.get(d, [])} == plain_anchors(t)
    assert 0.07 < len(got[1]) / len(middle.encode()) < 0.16


def test_matches_need_a_place(spark):
    """Moved passages count, scattered single anchors don't; edits in the middle leave both sides matched."""
    rnd = random.Random(2)
    base = ["".join(rnd.choice("abcdefghij ") for _ in range(3000)) for _ in range(4)]
    texts = [base[0], base[0][:1500] + "an insertion" + base[0][1500:], "moved " + base[0][500:2500], base[1], base[1][:1000] + base[2][:2000], base[3], base[3]]
    out = {r["doc_id"]: r for r in syncmers.compare_with_next(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    near = [out[k]["near_next"] for k in range(7)]
    assert near == [plain_likeness(plain_anchors(texts[k]), plain_anchors(texts[(k + 1) % 7])) for k in range(7)]
    assert near[0] > 0.9 and 0.5 < near[1] < 0.8 and near[2] < 0.01 and 0.15 < near[3] < 0.3 and near[5] == 1.0


def test_syncmers_awkward(spark, awkward, nothing, monkeypatch):
    many = [(7, "first of two texts", "en", "a")] * 70 + [(None, None, None, None)] * 3
    rows = AWKWARD + many

    def key(r):
        return (r[0] is not None, r[0] or 0, _signed(_hash((r[1] or "").encode())), r[1] or "")

    order = sorted(map(key, rows))
    want = sorted((d if known else -1, t, t[: len(t) - len(t) // 2] + order[(k + 1) % len(order)][3][: len(t) // 2]) for k, (known, d, _, t) in enumerate(order))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("found", F.lit("clash")).withColumn("h", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("__range", F.lit(2)).repartition(5)
    for range_bytes, listed in ((1 << 24, 256), (200, 256), (2_000, 3)):
        monkeypatch.setattr(syncmers, "LISTED", listed)
        out = syncmers.compare_with_next(df, range_bytes=range_bytes).collect()
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"], r["edited"]) for r in out) == want
    assert syncmers.compare_with_next(nothing).count() == 0
    lone = syncmers.compare_with_next(spark.createDataFrame([(9, "a b c d e f")], "doc_id long, text string")).first()
    assert lone["near_next"] == 1.0
    named = syncmers.compare_with_next(spark.createDataFrame([("x", "a"), ("12", "b")], "doc_id string, text string")).collect()
    assert {r["doc_id"] for r in named} == {None, 12}


# --- pages --------------------------------------------------------------------------------------------------------------------------


PAGE = (
    '<html><head><title>T</title><style>p{}</style></head><body><header>Top</header><nav><a href="/">Menu entry</a></nav>'
    '<div class="cookie-notice">We use cookies on this page and more.</div><div class="ad">Buy this now, it is a long advert text.</div>'
    '<article class="post-{n}"><h1>Head &amp; line</h1><p>First   paragraph with<br>some <b>bold</b> words &lt;ok&gt;.<p>Second&nbsp;one is here.'
    '<ul><li>one<li>two</ul><form><input>Form text</form><script>var x="</p>";</script><div class="share">Share me</div></article>'
    '<section class="comments"><p>A very long reader comment that is longer than the article itself, really, it goes on and on and on.</p></section>'
    "<aside>Side</aside><footer>&copy; foot</footer></body></html>"
)
TEXT = "Head & line\nFirst paragraph with some bold words <ok>.\nSecond one is here.\none\ntwo"


def test_main_text(spark):
    rows = [(i, f"http://h{i % 2}.com/{i}", PAGE.replace("{n}", str(i))) for i in range(6)]
    rows += [(10, None, PAGE), (11, "http://h0.com/x", ""), (12, "http://h0.com/x", None), (13, "http://h0.com/y", "plain &amp; bare"), (14, "http://h1.com", "<div><p>only a div here with some text"), (15, "http://h1.com", "<!-- never closed"), (None, "x", "<p>a</p><p>b</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("clash")).withColumn("votes", F.lit("clash")).withColumn("main", F.lit(0))
    for bound in (200_000, 0):
        got = {r["page_id"]: r["main_text"] for r in html_text.extract(df, keep=["page_id", "url"], broadcast_bytes=bound).collect()}
        assert all(got[i] == TEXT for i in [*range(6), 10])
        assert (got[11], got[12], got[13], got[14], got[15], got[None]) == ("", "", "plain & bare", "only a div here with some text", "", "a\nb")
    assert html_text.extract(df.where("false"), keep=["page_id"]).count() == 0


def test_consensus_beats_one_page(spark):
    usual = "<div class='main-{}'><p>{}</p></div><div class='extra'><p>{}</p></div>"
    rows = [(i, "http://a.com/", usual.format(i, "body words of the page " * 4, "short extra text that stays")) for i in range(5)]
    rows.append((9, "http://a.com/", usual.format(9, "the real but brief body of this page", "a far longer extra block " * 20)))
    got = {r["page_id"]: r["main_text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), keep=["page_id"]).collect()}
    assert got[9] == "the real but brief body of this page"


def test_pages_of_the_table(spark, sf_dir):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in html_text.op9_html_text(spark, sf_dir).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(b for b in parts if b) and r["n_chars"] == len(r["text"])


# --- toxicity -------------------------------------------------------------------------------------------------------------------------


def test_toxicity(spark, awkward, nothing):
    rnd = random.Random(2)
    calm = [f"calm{i}" for i in range(300)]
    rude = ["fiend", "lout", "cad"]
    rows, labels = [], []
    for i in range(900):
        words = [rnd.choice(calm) for _ in range(rnd.randint(20, 200))]
        level = i % 4 if i % 8 < 4 else 0
        for _ in range(level * len(words) // 25 + (level > 0)):
            words.insert(rnd.randrange(len(words)), rnd.choice(rude))
        rows.append((i, " ".join(words)))
        labels.append((i, int(level > 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([x for x in labels if x[0] % 3] + [(None, 1), (5000, None), (1, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    assert (np.diff(model.thresholds) > 0).all() and (model.weights >= 0).all()
    out = {r["doc_id"]: r for r in toxicity.grade(docs, model, keep=["doc_id"]).collect()}
    held = [(i, t) for i, t in labels if i % 3 == 0]
    assert sum(out[i]["toxic"] == bool(t) for i, t in held) / len(held) >= 0.97
    by_level = [np.mean([out[i]["severity"] for i, _ in held if (i % 4 if i % 8 < 4 else 0) == k]) for k in range(4)]
    assert by_level == sorted(by_level)
    extra = toxicity.grade(awkward, model, keep=["doc_id", "seq"]).collect()
    assert len(extra) == len(AWKWARD) and not any(r["toxic"] for r in extra)
    assert toxicity.fit(nothing, known.where("false")) is None
    assert toxicity.fit(docs, known.where("toxic = 0")) is None
    assert toxicity.grade(nothing, model, keep=["doc_id"]).count() == 0
    assert {r["severity"] for r in toxicity.grade(awkward, None, keep=["doc_id"]).collect()} == {0.0}


def test_ordinal_fit_gradient():
    rng = np.random.default_rng(0)
    x = rng.random((400, 3))
    s = x @ np.array([3.0, 1.0, 0.0]) + rng.logistic(size=400) * 0.3
    grades = np.digitize(s, [1.5, 2.5])
    w, theta = toxicity.fit_ordinal(np.repeat(np.arange(400), 3), np.tile(np.arange(3), 400), x.ravel(), grades, 3, steps=1500, l2=0.0)
    assert w[0] > w[1] > w[2] and theta[0] < theta[1]
