"""Queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm import bfd_pack, decontaminate, html_text, ppm_language, simhash, suffix_dedup, syncmers, toxicity, url_filter, vector_pack

Query = Callable[[SparkSession, str], DataFrame]


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository's top, beside __spark_entry__

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_token_packing": bfd_pack.op1_token_packing,
        "op2_url_filter": url_filter.op2_url_filter,
        "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
        "op4_ppm_language": ppm_language.op4_ppm_language,
        "op5_vector_packing": vector_pack.op5_vector_packing,
        "op6_simhash": simhash.op6_simhash,
        "op7_decontamination": decontaminate.op7_decontamination,
        "op8_syncmers": syncmers.op8_syncmers,
        "op9_html_text": html_text.op9_html_text,
        "op10_ordinal_toxicity": toxicity.op10_ordinal_toxicity,
        "pipeline": _pipeline,
    }


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {
        "op2_url_filter": url_filter.OP2_SQL,
        "op7_decontamination": decontaminate.OP7_SQL,
    }
    if corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
