"""Classification against a closed taxonomy: candidates, verdicts, calibration, exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.vectors import cosine

#: The closed vocabularies of a verdict.
BUCKETS = ["SURE", "NEEDS_HUMAN_VALIDATION", "I_GUESSED"]
RELATIONS = ["none", "comparison", "relationship", "progression"]
#: P10: fixed values, trust by bucket.
TRUST = {"SURE": "high", "NEEDS_HUMAN_VALIDATION": "needs_review", "I_GUESSED": "low"}

VERDICT = "reasoning_brief string, primary_subdomain string, secondary_subdomains array<string>, relation_type string, confidence_bucket string, confidence string"


def top_candidates(docs: DataFrame, centroids: DataFrame, key: str, vector: str, label: str, k: int) -> DataFrame:
    """Per document the k labels whose centroids are nearest, by score, then label.

    The centroids are one per class of a closed taxonomy (5 to 50), joined into one
    row and ranked in the documents' own rows: no shuffle of documents.
    """
    table = centroids.agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"), F.col("centroid").alias("c")))).alias("cs")).first()["cs"]
    if len(table) > 1000:
        raise ValueError("a taxonomy has at most 1000 classes")
    cs = F.array(*[F.struct(F.lit(r["label"]).alias("label"), F.array(*[F.lit(x) for x in r["c"]]).alias("c")) for r in table])
    scored = F.transform(cs, lambda z: F.struct((-F.round(cosine(F.col(vector), z["c"]), 6)).alias("neg"), z["label"].alias("label")))
    best = F.slice(F.array_sort(scored), 1, k)
    return docs.select(F.col(key), F.posexplode(best).alias("pos", "x")).select(key, (F.col("pos") + 1).cast("long").alias("rank"), F.col("x.label").alias("label"), (-F.col("x.neg") + 0.0).alias("score"))


def reject_reason(json: Column, taxonomy: list[str]) -> Column:
    """The first reason to reject a verdict, in the defined order; null if it is valid."""
    v = F.from_json(json, VERDICT)
    numeric = F.get_json_object(json, "$.confidence")
    is_number = numeric.isNotNull() & (numeric.rlike("^-?[0-9]+(\\.[0-9]+)?([eE][-+]?[0-9]+)?$") | numeric.isin("true", "false"))
    known = F.array(*[F.lit(t) for t in taxonomy])
    return (
        F.when(F.try_parse_json(json).isNull() | v.isNull(), "bad_json")
        .when(is_number, "numeric_confidence")
        .when(~F.coalesce(v["confidence_bucket"], F.lit("")).isin(BUCKETS), "bad_bucket")
        .when(~F.coalesce(v["relation_type"], F.lit("none")).isin(RELATIONS), "bad_relation")
        .when(F.trim(F.coalesce(v["reasoning_brief"], F.lit(""))) == "", "no_reasoning")
        .when(~F.array_contains(known, F.coalesce(v["primary_subdomain"], F.lit(""))), "bad_primary")
        .when(F.exists(F.coalesce(v["secondary_subdomains"], F.array().cast("array<string>")), lambda s: ~F.array_contains(known, s)), "bad_secondary")
    )


def trust(bucket: Column) -> Column:
    """P10."""
    table = F.create_map(*[F.lit(x) for kv in TRUST.items() for x in kv])
    return F.coalesce(F.try_element_at(table, bucket), F.lit("needs_review"))


def classify(verdicts: DataFrame, ledger: DataFrame, taxonomy: list[str]) -> DataFrame:
    """(doc_id, outcome, primary, trust); valid rows are applied even if others fail, known ones are skipped."""
    v = verdicts.select("doc_id", "json", reject_reason(F.col("json"), taxonomy).alias("reason"), F.get_json_object("json", "$.primary_subdomain").alias("primary"), F.get_json_object("json", "$.confidence_bucket").alias("bucket"))
    seen = ledger.select("doc_id", "primary").distinct().withColumn("seen", F.lit(True))
    joined = v.join(seen, ["doc_id", "primary"], "left")
    outcome = F.coalesce("reason", F.when(F.col("seen"), "skipped").otherwise("classified"))
    return joined.select("doc_id", outcome.alias("outcome"), "primary", F.when(outcome == "classified", trust(F.col("bucket"))).alias("trust"))


def bucket_accuracy(graded: DataFrame) -> DataFrame:
    """A2: (bucket, n, correct, accuracy) over bucket, truth, pred; buckets without rows too."""
    base = graded.sparkSession.createDataFrame([(b,) for b in BUCKETS], "bucket string")
    sums = graded.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if(F.col("truth") == F.col("pred")).alias("correct"))
    zero = F.lit(0).cast("long")
    return base.join(sums, "bucket", "left").select("bucket", F.coalesce("n", zero).alias("n"), F.coalesce("correct", zero).alias("correct"), F.when(F.col("n") > 0, F.round(F.col("correct") / F.col("n"), 4)).alias("accuracy"))


def confusion(graded: DataFrame, top: int = 10) -> DataFrame:
    """A3: the most frequent (truth, pred) cells, of which the right ones are then left out."""
    return graded.groupBy("truth", "pred").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "truth", "pred").limit(top).where("truth <> pred")


def glossary_miss(graded: DataFrame) -> DataFrame:
    """A4: overall accuracy, accuracy of guesses, and whether guesses miss more often than not."""
    hit = (F.col("truth") == F.col("pred")).cast("double")
    guessed = F.avg(F.when(F.col("bucket") == "I_GUESSED", hit))
    return graded.agg(F.round(F.avg(hit), 4).alias("accuracy"), F.round(guessed, 4).alias("guessed_accuracy"), F.coalesce(1 - guessed > 0.5, F.lit(False)).alias("glossary_miss"))


#: Fixed values, documents that a stage takes at most.
CAPS = {"retrieve": 1000, "judge": 2000, "export": 5000}


def capped(docs: DataFrame, key: str, stage: str) -> DataFrame:
    """The first documents by key, as many as the stage takes; only on request, no query uses it."""
    return docs.orderBy(key).limit(CAPS[stage])


def disagreement(candidates: DataFrame, key: str, band: float = 0.10) -> DataFrame:
    """Documents whose two best candidates are within ``band``."""
    two = candidates.where("rank <= 2").groupBy(key).agg(F.max("score").alias("a"), F.min("score").alias("b"), F.count("*").alias("n"))
    return two.where((F.col("n") == 2) & (F.round(F.col("a") - F.col("b"), 6) <= band)).select(key, F.round(F.col("a") - F.col("b"), 6).alias("gap"))


def stratified(docs: DataFrame, key: str, label: str, per_label: int = 8) -> DataFrame:
    """So many documents of each label, the first by a hash of their key (a sampling operator)."""
    order = W.partitionBy(label).orderBy(F.sha2(F.col(key).cast("string").cast("binary"), 256), key)
    return docs.withColumn("pick", F.row_number().over(order).cast("long")).where(F.col("pick") <= per_label)


def prompt(glossary: str, candidates: Column, body: Column, examples: int = 3) -> Column:
    """glossary, the candidates with their first examples, and the document, each cut to its share."""
    shown = F.array_join(F.transform(candidates, lambda c: F.concat(F.lit("- "), c["label"], F.lit(": "), c["definition"], F.array_join(F.transform(F.slice(c["examples"], 1, examples), lambda e: F.concat(F.lit("\n  e.g. "), F.substring(e, 1, 200))), ""))), "\n")
    return F.concat(F.lit(glossary[:2000]), F.lit("\n\n"), shown, F.lit("\n\n"), F.substring(body, 1, 6000))


def verdict_schema(taxonomy: list[str]) -> dict:
    """the JSON schema of a verdict; reasoning comes first, nothing else is allowed."""
    return {
        "type": "object",
        "properties": {
            "reasoning_brief": {"type": "string"},
            "primary_subdomain": {"type": "string", "enum": sorted(taxonomy)},
            "secondary_subdomains": {"type": "array", "items": {"type": "string", "enum": sorted(taxonomy)}},
            "relation_type": {"type": "string", "enum": RELATIONS},
            "confidence_bucket": {"type": "string", "enum": BUCKETS},
        },
        "required": ["reasoning_brief", "primary_subdomain", "secondary_subdomains", "relation_type", "confidence_bucket"],
        "additionalProperties": False,
    }


def label_tasks(docs: DataFrame, candidates: DataFrame, verdicts: DataFrame, key: str, html: str) -> DataFrame:
    """A labelling task per document as JSON, with its candidates and verdict if there are any."""
    best = candidates.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "label", "score"))).alias("candidates"))
    joined = docs.join(best, key, "left").join(verdicts, key, "left")
    return joined.select(key, F.to_json(F.struct(F.struct(F.col(key).alias("doc_id"), F.col(html).alias("html"), F.coalesce(F.to_json(F.transform("candidates", lambda c: F.struct(c["label"].alias("label"), c["score"].alias("score")))), F.lit("[]")).alias("candidates"), F.coalesce("primary", F.lit("")).alias("model_primary")).alias("data"))).alias("task"))


def label_view(choices: list[str]) -> str:
    """The labelling form with a choice per class."""
    options = "".join(f'<Choice value="{c}"/>' for c in choices)
    return f'<View><HyperText name="doc" value="$html"/><Choices name="primary" toName="doc" choice="single">{options}</Choices></View>'


def gold_join(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """J8, by equality of ids (a deviation): the prediction, else the gold row's own; rows without either are dropped."""
    joined = gold.join(predictions.select("doc_id", F.col("pred").alias("found"), "bucket"), "doc_id", "left")
    return joined.select("doc_id", "truth", F.coalesce("found", "pred").alias("pred"), F.coalesce("bucket", F.lit("I_GUESSED")).alias("bucket")).where("pred IS NOT NULL")


def chain(docs: DataFrame, gold: DataFrame, taxonomy: list[str], chunk: Callable[[Column], Column], embed: Callable[[Column], Column], judge: Callable[[DataFrame], Column], centroids: DataFrame, k: int) -> dict[str, DataFrame]:
    """Chunk, retrieve, judge, export and calibrate one after the other: the tables of every step.

    ``docs``: doc_id, text; ``gold``: doc_id, truth; ``centroids``: label, centroid.
    ``embed`` and ``judge`` are the caller's models (X4): expressions, the latter over
    doc_id, chunk and candidates (an array of label and score, best first), that gives a
    verdict as JSON.  A document whose verdict is rejected has no prediction.
    """
    chunks = docs.select("doc_id", chunk(F.col("text")).alias("chunk"))
    found = top_candidates(chunks.select("doc_id", embed(F.col("chunk")).alias("v")), centroids, "doc_id", "v", "label", k)
    best = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("rank", "label", "score"))).alias("candidates"))
    judged = chunks.join(best, "doc_id", "left")
    judged = judged.select("doc_id", "chunk", judge(judged).alias("json")).withColumn("reason", reject_reason(F.col("json"), taxonomy))
    valid = judged.where("reason IS NULL").select("doc_id", F.get_json_object("json", "$.primary_subdomain").alias("pred"), F.get_json_object("json", "$.confidence_bucket").alias("bucket"))
    tasks = label_tasks(chunks.select("doc_id", "chunk"), found, valid.select("doc_id", F.col("pred").alias("primary")), "doc_id", "chunk")
    graded = gold.join(valid, "doc_id").select("doc_id", "truth", "pred", "bucket")
    return {"chunks": chunks, "candidates": found, "verdicts": judged.select("doc_id", "json", "reason"), "tasks": tasks, "graded": graded, "calibration": bucket_accuracy(graded)}
