"""Imports every module that registers queries."""

from quillspark.plans import command_queries, corpus_queries, quality_queries, vault_queries  # noqa: F401
