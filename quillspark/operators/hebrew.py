"""Repair of reversed Hebrew: dictionary counts, word fixes, greedy phrase fixes."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.binding import let
from quillspark.functions.shipping import ship
from quillspark.operators.detectors import FINALS

#: The margin and the least frequency of a fix.
MARGIN, MIN_SCORE = 2.0, 1e-5
TOKEN = "[\\u0590-\\u05FF]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def counts(docs: DataFrame, text: str) -> DataFrame:
    """(kind, item, n) of words and of 2- and 3-grams of trusted texts; grams are cut in the row, then counted."""
    t = docs.select(tokens(F.col(text)).alias("t"))

    def grams(n: int) -> Column:
        last = F.size("t") - n
        return F.when(last >= 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(0)) + 1), lambda i: F.array_join(F.slice("t", i, n), " "))).otherwise(F.array().cast("array<string>"))

    each = t.select(F.explode(F.array(F.struct(F.lit("word").alias("kind"), F.col("t").alias("items")), F.struct(F.lit("phrase").alias("kind"), F.concat(grams(2), grams(3)).alias("items")))).alias("x"))
    return each.select("x.kind", F.explode("x.items").alias("item")).groupBy("kind", "item").agg(F.count("*").alias("n"))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """A dictionary with the counts of a further run."""
    return old.unionByName(new).groupBy("kind", "item").agg(F.sum("n").alias("n"))


def frequencies(dictionary: DataFrame) -> DataFrame:
    """(kind, item, freq); the totals are one row per kind."""
    total = dictionary.groupBy("kind").agg(F.sum("n").alias("total"))
    return dictionary.join(F.broadcast(total), "kind").select("kind", "item", (F.col("n") / F.col("total")).alias("freq"))


def word_decision(word: Column, cur: Column, rev: Column, ocr: Column, margin: float = MARGIN, min_score: float = MIN_SCORE) -> Column:
    """H2: keep, fix or ambiguous, from a word's frequency and its reversal's."""
    final = F.substring(word, 1, 1).isin(list(FINALS))
    own = F.when(final, F.lit(0.0)).otherwise(cur)
    return F.when(F.length(word) < 2, "keep").when(~final & ~ocr, "keep").when((rev < min_score) | (rev <= own), "keep").when((own == 0) | (rev >= own * margin), "fix").otherwise("ambiguous")


def fix_words(words: DataFrame, dictionary: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """H2, H3: (word, ocr) rows with decision and fixed; ``baseline`` (word, freq) adds general frequencies."""
    freq = frequencies(dictionary).where("kind = 'word'").select(F.col("item").alias("w"), "freq")
    if baseline is not None:
        freq = freq.union(baseline.select("word", "freq")).groupBy("w").agg(F.sum("freq").alias("freq"))
    a, b = freq.toDF("word", "cur"), freq.toDF("reversed", "rev")
    joined = words.withColumn("reversed", F.reverse("word")).join(a, "word", "left").join(b, "reversed", "left")
    d = word_decision(F.col("word"), F.coalesce("cur", F.lit(0.0)), F.coalesce("rev", F.lit(0.0)), F.col("ocr"))
    return joined.select("word", "ocr", d.alias("decision"), F.when(d == "fix", F.col("reversed")).otherwise(F.col("word")).alias("fixed"))


def two_passes(docs: DataFrame, text: str, ocr: str, baseline: DataFrame | None = None, old: DataFrame | None = None) -> DataFrame:
    """H6: (word, decision, fixed) of the scanned documents' words; only the others make the dictionary, on top of an older one."""
    own = counts(docs.where(~F.col(ocr)), text)
    scanned = docs.where(F.col(ocr)).select(F.explode(tokens(F.col(text))).alias("word")).distinct().withColumn("ocr", F.lit(True))
    return fix_words(scanned, own if old is None else merged(old, own), baseline).select("word", "decision", "fixed")


def _askable(text: Column) -> Column:
    """All that a fix can ask for of a text: its words, its 2- and 3-grams, and their reversals; every word of a gram plain or turned, for word fixes come first."""
    spellings = F.transform(tokens(text), lambda w: F.array_distinct(F.array(w, F.reverse(w))))
    pair = lambda a, b: F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.concat_ws(" ", x, y))))

    def asked(s: Column) -> Column:
        last = lambda n: F.size(s) - n
        twos = F.when(last(2) >= 0, F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(last(2), F.lit(0))), lambda i: pair(F.get(s, i), F.get(s, i + 1))))).otherwise(F.array().cast("array<string>"))
        threes = F.when(last(3) >= 0, F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(last(3), F.lit(0))), lambda i: pair(pair(F.get(s, i), F.get(s, i + 1)), F.get(s, i + 2))))).otherwise(F.array().cast("array<string>"))
        phrases = F.concat(twos, threes)
        turned = F.transform(phrases, lambda p: F.array_join(F.reverse(F.split(p, " ")), " "))
        named = lambda items, kind: F.transform(items, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("item")))
        return F.concat(named(F.flatten(s), "word"), named(F.array_distinct(F.concat(phrases, turned)), "phrase"))

    return let(spellings, asked)


def fix_texts(docs: DataFrame, dictionary: DataFrame, text: str, ocr: str, key: str = "doc_id") -> DataFrame:
    """Adds ``repair``: fixed, fixed_words, fixed_phrases, ambiguous, hebrew_fixed.

    Phrases are decided from left to right, three words before two, so the rest of
    a run depends on what was fixed before: an Arrow UDF.  Every document gets the
    frequencies of its own words and phrases and their reversals beside it, by joins;
    no task or driver holds the dictionary.  Word fixes come first, so phrases of the
    fixed words are asked for as well.  ``key`` tells documents apart.
    """
    ship(docs.sparkSession)
    freq = frequencies(dictionary)
    each = docs.select(F.col(key).alias("__key"), F.explode(_askable(F.col(text))).alias("x")).select("__key", "x.kind", "x.item").distinct()
    held = each.join(freq, ["kind", "item"]).groupBy("__key").agg(F.collect_list(F.struct("kind", "item", "freq")).alias("__freq"))
    joined = docs.join(held, docs[key] == held["__key"], "left").drop("__key")

    @F.pandas_udf("fixed string, fixed_words array<string>, fixed_phrases array<string>, ambiguous array<string>, hebrew_fixed boolean")
    def repair(texts: pd.Series, scanned: pd.Series, known: pd.Series) -> pd.DataFrame:
        rows = []
        for t, o, f in zip(texts, scanned, known, strict=True):
            words = {x["item"]: x["freq"] for x in (f if f is not None else ()) if x["kind"] == "word"}
            phrases = {x["item"]: x["freq"] for x in (f if f is not None else ()) if x["kind"] == "phrase"}
            rows.append(_repaired(t, bool(o), words, phrases))
        return pd.DataFrame(rows, columns=["fixed", "fixed_words", "fixed_phrases", "ambiguous", "hebrew_fixed"])

    return joined.withColumn("repair", repair(F.col(text), F.col(ocr), F.col("__freq"))).drop("__freq")


def _judge(cur: float, rev: float) -> str:
    if rev < MIN_SCORE or rev <= cur:
        return "keep"
    return "fix" if cur == 0 or rev >= cur * MARGIN else "ambiguous"


def _repaired(text: str | None, ocr: bool, words: dict[str, float], phrases: dict[str, float]) -> tuple:
    fixed_words, fixed_phrases, ambiguous = [], [], []
    if text is None:
        return None, [], [], [], False

    def word(m: re.Match) -> str:
        w = m[0]
        final = w[0] in FINALS
        if len(w) < 2 or not (final or ocr):
            return w
        verdict = _judge(0.0 if final else words.get(w, 0.0), words.get(w[::-1], 0.0))
        if verdict == "fix":
            fixed_words.append(w)
            return w[::-1]
        if verdict == "ambiguous":
            ambiguous.append(w)
        return w

    def run(m: re.Match) -> str:
        left, out = m[0].split(" "), []
        while left:
            size = 1
            for n in (3, 2):
                if len(left) < n:
                    continue
                phrase = " ".join(left[:n])
                verdict = _judge(phrases.get(phrase, 0.0), phrases.get(" ".join(left[n - 1 :: -1]), 0.0))
                if verdict == "fix":
                    fixed_phrases.append(phrase)
                    size = n
                elif verdict == "ambiguous":
                    ambiguous.append(phrase)
                if verdict != "keep":
                    break
            out += left[:size][::-1]
            left = left[size:]
        return " ".join(out)

    text = re.sub("[֐-׿]+", word, text)
    if ocr:
        text = re.sub("[֐-׿]+(?: [֐-׿]+)+", run, text)
    return text, fixed_words, fixed_phrases, ambiguous, bool(fixed_words or fixed_phrases)
